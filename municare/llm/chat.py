"""Logged conversations collapsed to the maximal ones and rendered as training text.

Method: chat logs hold a snapshot per turn, so short conversations are prefixes of longer ones.
A rolling hash names every prefix of every conversation: the exclusive or of two 64-bit hashes
of (place, role, text) over the turns so far. A conversation goes when another one that goes on
has its last hash among its prefixes (an anti join); of equal conversations the smallest id
stays. Prefixes and ends are grouped before they meet, so a first turn or a conversation that a
third of the log shares is one row. Rendering joins the turns in parts of bounded length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municare.llm.common import stored, with_running_sum

PART_TURNS = 1_000  # turns rendered into one text; longer conversations give several parts
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def placed_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): turns numbered from 1 on within their conversation.

    Turns that repeat in all four columns count once. Turns order by number (null first), then
    role, then text. The number comes from a distributed count, so a conversation of any size
    is shared by many tasks.
    """
    rows = turns.select("conv_id", "turn", "role", "text").distinct()
    rows = rows.withColumn("__one", F.lit(1).cast("long"))
    order = [F.col("turn"), F.col("role"), F.col("text")]
    return with_running_sum(rows, ["conv_id"], order, "__one", "place", "turns").drop("turn", "__one")


def _running_xor(rows: DataFrame) -> DataFrame:
    """Adds h1 and h2, the hashes of the prefix that ends at each turn.

    Exclusive or has no order, so a range of places is first reduced to one value, as in a
    running sum: blocks of PART_TURNS turns and the value that the blocks before give.
    """
    from pyspark.sql import Window

    block = ((F.col("place") - 1) / F.lit(PART_TURNS)).cast("long")
    content = [F.col("place"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    rows = rows.select(
        "conv_id", "place", block.alias("block"),
        F.xxhash64(F.lit(1), *content).alias("h1"),
        F.xxhash64(F.lit(2), *reversed(content)).alias("h2"),
    )
    totals = rows.groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("t1"), F.bit_xor("h2").alias("t2"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("conv_id").alias("__conv"), F.col("block").alias("__block"),
        F.coalesce(F.bit_xor("t1").over(earlier), F.lit(0)).alias("t1"),
        F.coalesce(F.bit_xor("t2").over(earlier), F.lit(0)).alias("t2"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("h1", F.bit_xor("h1").over(inside)).withColumn("h2", F.bit_xor("h2").over(inside))
    same = [F.col("conv_id").eqNullSafe(F.col("__conv")), F.col("block") == F.col("__block")]
    rows = rows.join(totals, same)
    return rows.select(
        "conv_id", "place", F.col("h1").bitwiseXOR(F.col("t1")).alias("h1"), F.col("h2").bitwiseXOR(F.col("t2")).alias("h2")
    )


def maximal(placed: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that are no prefix of another one.

    Of equal conversations the one with the smallest id stays, null before all.
    """
    prefixes = stored(_running_xor(placed), "prefixes")
    ends = prefixes.groupBy("conv_id").agg(F.max("place").alias("n_turns"))
    ends = stored(ends.select(F.col("conv_id").alias("__conv"), "n_turns"), "ends")
    joined = prefixes.join(ends, F.col("conv_id").eqNullSafe(F.col("__conv")))
    whole = joined.filter("place = n_turns").groupBy("n_turns", "h1", "h2")
    smallest = F.min(F.struct(F.col("conv_id").isNotNull().alias("named"), F.col("conv_id").alias("id")))
    whole = whole.agg(smallest.alias("first"))
    longer = joined.filter("place < n_turns").select(F.col("place").alias("n"), F.col("h1").alias("p1"), F.col("h2").alias("p2")).distinct()
    same = (F.col("n_turns") == F.col("n")) & (F.col("h1") == F.col("p1")) & (F.col("h2") == F.col("p2"))
    return whole.join(longer, same, "left_anti").select(F.col("first.id").alias("conv_id"), "n_turns")


def rendered(role: Column, text: Column) -> Column:
    """One turn of the template; a null role or text is empty."""
    empty = F.lit("")
    return F.concat(
        F.lit(OPEN), F.coalesce(role, empty), F.lit("\n"), F.coalesce(text, empty), F.lit(CLOSE + "\n")
    )


def format_chats(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Per maximal conversation and part of ``part_turns`` turns: conv_id, part (from 0), n_turns
    of the conversation, and the rendered text.

    A null conv_id is an id like any other. Null roles and texts are told from empty ones when
    conversations are compared and render as empty. Other columns are not read; an empty table
    gives no rows.
    """
    placed = stored(placed_turns(turns), "placed")
    kept = stored(maximal(placed).select(F.col("conv_id").alias("__conv"), "n_turns"), "maximal")
    rows = placed.join(kept, F.col("conv_id").eqNullSafe(F.col("__conv")))
    part = ((F.col("place") - 1) / F.lit(part_turns)).cast("int").alias("part")
    rows = rows.select("conv_id", part, "n_turns", F.struct("place", rendered(F.col("role"), F.col("text")).alias("turn")).alias("turn"))
    # At most part_turns turns meet in a group.
    parts = rows.groupBy("conv_id", "part", "n_turns").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return parts.select("conv_id", "part", "n_turns", F.array_join("turns.turn", "").alias("rendered"))
