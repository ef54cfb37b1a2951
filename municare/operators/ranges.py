"""Interval lookups without a nested-loop join, and the proof that ranges are disjoint."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municare.operators.order import running_max_before, running_sum

BLOCK = 1_024  # places of one level that make a block of the next
LEVELS = 3


def range_lookup(
    rows: DataFrame,
    code: str,
    ranges: DataFrame,
    low: str,
    high: str,
    take: Mapping[str, str],
) -> DataFrame:
    """Left join on ``low <= code <= high`` (inclusive, binary order).

    A code inside a range starts with a character between the first characters of the two
    bounds, so each range is listed under those characters and the join becomes an equi-join
    with the bounds as a residual condition. Overlapping ranges give one row each.
    """
    side = ranges.select(
        F.col(low).alias("__low"),
        F.col(high).alias("__high"),
        *[F.col(c).alias(name) for c, name in take.items()],
        F.explode(F.sequence(F.ascii(low), F.ascii(high))).alias("__initial"),
    )
    condition = (F.ascii(rows[code]) == side["__initial"]) & rows[code].between(
        side["__low"], side["__high"]
    )
    return rows.join(side, condition, "left").drop("__low", "__high", "__initial")


def resolve_codes(
    rows: DataFrame,
    code: str,
    lookup_code,
    ranges: DataFrame,
    low: str,
    high: str,
    take: Mapping[str, str],
) -> DataFrame:
    """Resolve each distinct code once; ``lookup_code`` is the code as the ranges spell it."""
    codes = rows.select(code).distinct().withColumn("__lookup", lookup_code)
    return range_lookup(codes, "__lookup", ranges, low, high, take).drop("__lookup")


def sweep_lookup(
    rows: DataFrame,
    code: str,
    ranges: DataFrame,
    low: str,
    high: str,
    take: Mapping[str, str],
) -> DataFrame:
    """Left join on ``low <= code <= high`` (inclusive) for keys of any ordered type, for ranges
    of any number, length and overlap.

    Distinct codes and the ends of all ranges are sorted into one order and the codes counted along it:
    a code then has a place, and a range covers the places from a to b. Inside blocks of places that a range
    covers whole it is listed once per block (1,024 or 1,048,576 places), at its two edges once per place, so
    it never takes more than some thousand entries and a code is listed once per level. Blocks and
    places join on equality, and a pair comes out exactly once. What is shuffled grows with codes
    and ranges, not with the pairs; a block that many ranges cover is split by AQE, as both sides
    come straight from a shuffle.

    A NULL code and a range with a NULL end or with ends the wrong way round match nothing.
    """
    kind = rows.schema[code].dataType
    codes = rows.select(F.col(code).alias("__key")).filter("__key is not null").distinct()
    sides = ranges.select(
        F.monotonically_increasing_id().alias("__id"), F.col(low).cast(kind).alias("__low"),
        F.col(high).cast(kind).alias("__high"), *[F.col(c).alias(name) for c, name in take.items()],
    ).filter("__low <= __high")
    # A low end comes before an equal code, a high end after it; both carry the content of their range.
    shape = F.struct(*[c for c in sides.columns if c not in ("__low", "__high")]).alias("__range_row")
    ends = [F.struct(F.col(end).alias("__key"), F.lit(what).alias("__what")) for end, what in (("__low", 0), ("__high", 2))]
    events = sides.select(F.explode(F.array(*ends)).alias("__end"), shape).select("__end.*", "__range_row")
    events = events.unionByName(codes.withColumn("__what", F.lit(1)), allowMissingColumns=True)
    order = [F.col("__key"), F.col("__what")]
    placed = running_sum(events, order, (F.col("__what") == 1).cast("long"), "__place", "sweep")

    ends = placed.filter("__what != 1").groupBy("__range_row").agg(
        F.max(F.when(F.col("__what") == 0, F.col("__place") + 1)).alias("__a"),
        F.max(F.when(F.col("__what") == 2, F.col("__place"))).alias("__b"),
    )
    covers = ends.filter("__a <= __b").select(
        *[F.col(f"__range_row.{name}").alias(name) for name in take.values()],
        F.explode(_cover(F.col("__a"), F.col("__b"))).alias("__at"),
    )
    covers = covers.select(*take.values(), "__at.level", F.explode(F.sequence("__at.first", "__at.last")).alias("__block"))
    listed = placed.filter("__what = 1").select(
        "__key",
        F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.expr(f"__place div {BLOCK**i}").alias("block")) for i in range(LEVELS)])).alias("__on"),
    ).select("__key", "__on.level", F.col("__on.block").alias("__block"))
    pairs = listed.join(covers, ["level", "__block"]).select(F.col("__key").alias("__code"), *take.values())
    return rows.join(pairs, rows[code] == pairs["__code"], "left").drop("__code")


def _cover(a: Column, b: Column) -> Column:
    """The places a to b as runs of whole blocks: (level, first, last), each place in exactly one block."""
    runs, low, high = [], a, b  # low..high: what is left, in places of the level
    for level in range(LEVELS):
        if level == LEVELS - 1:
            runs.append((level, low, high))
            break
        first, last = F.ceil(low / BLOCK), F.floor((high + 1) / BLOCK) - 1  # whole blocks of the next level
        whole = first <= last
        runs.append((level, low, F.when(whole, first * BLOCK - 1).otherwise(high)))
        runs.append((level, F.when(whole, (last + 1) * BLOCK), high))
        low, high = F.when(whole, first), F.when(whole, last)
    made = [
        F.when(first <= last, F.struct(F.lit(level).alias("level"), first.cast("long").alias("first"), last.cast("long").alias("last")))
        for level, first, last in runs
    ]
    return F.filter(F.array(*made), lambda r: r.isNotNull())


def overlapping(ranges: DataFrame, name: str, low: str, high: str) -> DataFrame:
    """(name, low, high, with_name, with_high): each range that begins inside an earlier one, with the
    earlier one that reaches farthest. No rows prove that the ranges are disjoint.

    Ranges are sorted by both ends and the greatest end so far is carried along, over the borders of
    the sorted parts too. A range with a NULL end or with ends the wrong way round holds nothing.
    """
    sides = ranges.select(F.col(name).alias("name"), F.col(low).alias("low"), F.col(high).alias("high")).filter("low <= high")
    order = [F.col("low"), F.col("high"), F.col("name")]
    seen = running_max_before(sides, order, F.struct("high", "name"), "__far", "overlap")
    return seen.filter("low <= __far.high").select(
        "name", "low", "high", F.col("__far.name").alias("with_name"), F.col("__far.high").alias("with_high")
    )
