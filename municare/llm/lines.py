"""Repeated line runs of a corpus: every copy but the first is deleted.

Method: the corpus is one sequence of line ids. Distributed prefix doubling ranks the suffixes
by their first 1, 2, 4, ... lines: the rank at length 2k is the order of the pair (rank at k
here, rank at k k lines on), found by a range sort of the distinct pairs. A suffix whose rank
nobody shares is dropped, as no repeat begins there. The suffixes that agree on their first m
lines are an interval of the suffix array whose longest common prefix is m or more; the pair
of ranks that covers m lines names it. For every line the shortest run of ``min_words`` words
that begins there, and the shortest that ends there, is looked up; every maximal repeated run
of that many words is a union of such runs. In each interval the earliest place in the corpus
stays and the lines of the others go.

A run never crosses documents. Levels end at the longest run that is looked up, ``min_words``
lines at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from municare.llm.common import map_texts, sliced, stored, texts_of, with_running_sum

MIN_WORDS = 50
PLACE = ("__id", "__text_key")


def worded_lines(text: bytes | None) -> list[tuple[int, bytes, int]]:
    """(line number, line, words) of the lines that hold a word; lines end at a line feed."""
    lines = enumerate(text.split(b"\n")) if text else ()
    return [(i, line, len(line.split())) for i, line in lines if _has_word(line)]


def shortest_runs(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Per line the number of lines of the shortest run of ``least`` words that begins there,
    and of the one that ends there; 0 where the document has none."""
    ends = np.concatenate([[0], np.cumsum(words)])
    at = np.arange(len(words))
    stop = np.searchsorted(ends, ends[:-1] + least, "left")
    ahead = np.where(stop <= len(words), stop - at, 0)
    start = np.searchsorted(ends, ends[1:] - least, "right") - 1
    back = np.where(start >= 0, at + 1 - start, 0)
    return ahead, back


def _line_rows(texts, least: int) -> dict[str, pa.Array]:
    stops, numbers, digests, aheads, backs = [0], [], [], [], []
    for text in texts:
        lines = worded_lines(text)
        ahead, back = shortest_runs(np.array([w for _, _, w in lines], np.int64), least)
        numbers += [n for n, _, _ in lines]
        digests += [xxhash.xxh3_128_digest(line) for _, line, _ in lines]
        aheads.append(ahead)
        backs.append(back)
        stops.append(len(numbers))
    whole = lambda parts: pa.array(np.concatenate([*parts, np.empty(0, np.int64)]), pa.int32())
    columns = [pa.array(numbers, pa.int32()), pa.array(digests, pa.binary()), whole(aheads), whole(backs)]
    flat = pa.StructArray.from_arrays(columns, names=["n", "line", "ahead", "back"])
    return {"__lines": pa.ListArray.from_arrays(pa.array(stops, pa.int32()), flat)}


def _ranked(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Rows whose ``keys`` are shared, with the rank of their keys among the shared ones."""
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    groups = groups.select(*keys, F.lit(1).cast("long").alias("__one"))
    ranks = with_running_sum(groups, [], [F.col(k) for k in keys], "__one", out, "ranks")
    ranks = stored(ranks.select(*[F.col(k).alias(f"__rank_{k}") for k in keys], out), "ranks")
    joined = rows.join(ranks, [F.col(k) == F.col(f"__rank_{k}") for k in keys])
    return joined.drop(*[f"__rank_{k}" for k in keys])


def repeated_lines(documents: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(__id, __text_key, lines): numbers of the lines to delete, for documents that have any.

    The order of the corpus is id (null last), then a hash of the text, then the line; rows
    that repeat an id and its text are one document. A copy that overlaps the first run of its
    own document loses only the lines behind that run.
    """
    slim = documents.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    slim = slim.withColumn("__text_key", F.xxhash64("__text"))
    kind = "__lines array<struct<n:int,line:binary,ahead:int,back:int>>"
    rows = map_texts(slim, list(PLACE), "__text", lambda t: _line_rows(t, min_words), kind)
    rows = rows.select(*PLACE, F.posexplode("__lines").alias("i", "at"))
    rows = rows.select(*PLACE, "i", F.col("at.n").alias("n"), F.col("at.line").alias("line"), F.col("at.ahead").alias("ahead"), F.col("at.back").alias("back"))
    # Lines that occur once break the sequence into islands of repeated lines.
    rows = stored(rows, "lines")
    known = rows.groupBy("line").agg(F.count(F.lit(1)).alias("count")).filter("count > 1")
    known = stored(known.select(F.col("line").alias("known")), "known")
    rows = rows.join(known, F.col("line") == F.col("known"), "left_semi")
    place = Window.partitionBy(*PLACE).orderBy("i")
    rows = rows.distinct()  # rows that repeat id and text
    rows = rows.withColumn("island", F.col("i") - F.row_number().over(place))
    island = Window.partitionBy(*PLACE, "island")
    rows = rows.withColumn("first", F.min("i").over(island)).withColumn("last", F.max("i").over(island))
    rows = rows.withColumn("ahead", F.when((F.col("ahead") > 0) & (F.col("i") + F.col("ahead") - 1 <= F.col("last")), F.col("ahead")))
    rows = rows.withColumn("back", F.when((F.col("back") > 0) & (F.col("i") - F.col("back") + 1 >= F.col("first")), F.col("back")))
    rows = rows.withColumn("longest", F.greatest(F.max("ahead").over(island), F.max("back").over(island)))
    rows = stored(rows.filter("longest is not null").drop("first", "last"), "islands")

    # ranks[k]: rank of the 2**k lines from here on, null where no other place shares them.
    longest = rows.agg(F.max("longest")).first()[0] or 0
    level = stored(_ranked(rows, ["line"], "rank").select(*PLACE, "i", "rank"), "rank0")
    levels = [level]
    while 2 ** len(levels) <= longest:
        half = 2 ** (len(levels) - 1)
        later = level.select(*[F.col(c).alias(f"__{c}") for c in PLACE], (F.col("i") - half).alias("__i"), F.col("rank").alias("then"))
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in PLACE] + [F.col("i") == F.col("__i")]
        pairs = stored(level.join(later, same).select(*PLACE, "i", F.col("rank").alias("now"), "then"), "pairs")
        level = stored(_ranked(pairs, ["now", "then"], "rank").select(*PLACE, "i", "rank"), f"rank{len(levels)}")
        levels.append(level)

    # A run of m lines lies under two blocks of the largest power of two that is within m.
    runs = rows.filter("ahead is not null").select(*PLACE, F.col("i").alias("start"), F.col("ahead").alias("m"))
    runs = runs.union(rows.filter("back is not null").select(*PLACE, F.col("i") - F.col("back") + 1, "back")).distinct()
    covered = []
    for k, level in enumerate(levels):
        here = level.select(*[F.col(c).alias(f"__{c}") for c in PLACE], F.col("i").alias("__i"), F.col("rank").alias("low"))
        end = level.select(*[F.col(c).alias(f"___{c}") for c in PLACE], F.col("i").alias("___i"), F.col("rank").alias("high"))
        own = runs.filter(F.col("m").between(2**k, 2 ** (k + 1) - 1))
        own = own.join(here, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in PLACE] + [F.col("start") == F.col("__i")])
        own = own.join(end, [F.col(c).eqNullSafe(F.col(f"___{c}")) for c in PLACE] + [F.col("start") + F.col("m") - 2**k == F.col("___i")])
        covered.append(own.select(*PLACE, "start", "m", "low", "high"))
    named = covered[0]
    for own in covered[1:]:
        named = named.union(own)
    named = stored(named, "runs")
    order = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__text_key").alias("key"), F.col("start").alias("start"))
    firsts = named.groupBy("m", "low", "high").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = stored(firsts.select(F.col("m").alias("__m"), F.col("low").alias("__low"), F.col("high").alias("__high"), "first"), "firsts")
    copies = named.join(firsts, (F.col("m") == F.col("__m")) & (F.col("low") == F.col("__low")) & (F.col("high") == F.col("__high")))
    same_text = F.col("__id").eqNullSafe(F.col("first.id")) & (F.col("__text_key") == F.col("first.key"))
    copies = copies.filter(~(same_text & (F.col("start") == F.col("first.start"))))
    begin = F.when(same_text, F.greatest("start", F.col("first.start") + F.col("m"))).otherwise(F.col("start"))
    copies = copies.withColumn("begin", begin).withColumn("end", F.col("start") + F.col("m") - 1).filter("begin <= end")
    gone = copies.select(*PLACE, F.explode(F.sequence("begin", "end")).alias("i")).distinct()
    numbers = rows.select(*[F.col(c).alias(f"__{c}") for c in PLACE], F.col("i").alias("__i"), "n")
    gone = gone.join(numbers, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in PLACE] + [F.col("i") == F.col("__i")])
    # One document's line numbers are no more than its text.
    return gone.groupBy(*PLACE).agg(F.collect_list("n").alias("lines"))


def _has_word(line: bytes) -> bool:
    return bool(line) and not line.isspace()


def _without(texts: list[bytes | None], deleted: list[list[int] | None]) -> dict[str, pa.Array]:
    out, counts = [], []
    for text, numbers in zip(texts, deleted):
        lines = text.split(b"\n") if text else []
        counts.append(sum(map(_has_word, lines)))
        if numbers:
            drop = set(numbers)
            left = [line for i, line in enumerate(lines) if i not in drop]
            text = b"\n".join(left) if any(map(_has_word, left)) else b""
        out.append(text)
    return {
        "__text": pa.array(out, pa.binary()).cast(pa.string()),
        "__n_lines": pa.array(counts, pa.int64()),
        "__n_deleted": pa.array([len(x or ()) for x in deleted], pa.int64()),
    }


def line_dedup(documents: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` with later copies of repeated line runs taken out of ``text``, and two
    columns more: ``n_lines``, lines with a word, and ``n_deleted``, those of them deleted.

    A run counts from ``min_words`` words on. Null and empty texts stay as they are; a text
    that loses all its worded lines becomes empty; lines without words stay beside kept ones.
    """
    gone = stored(repeated_lines(documents, id, text, min_words), "deleted")
    names = documents.columns
    slim = documents.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    at_id, at_text = f"c{names.index(id)}", names.index(text)
    others = [f"c{i}" for i in range(len(names)) if i != at_text]
    keyed = slim.withColumn("__key", F.xxhash64(f"c{at_text}"))
    # One plan at every size: texts and deletions meet by a sorted merge.
    joined = keyed.join(gone.hint("merge"), F.col(at_id).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__text_key")), "left")
    joined = joined.select(*others, "lines", F.col(f"c{at_text}").alias("__text"))
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in others) + ", __text string, __n_lines bigint, __n_deleted bigint"

    def run(batches):
        for batch in sliced(batches):
            made = _without(texts_of(batch.column(len(others) + 1)), batch.column(len(others)).to_pylist())
            columns = [batch.column(i) for i in range(len(others))] + list(made.values())
            yield pa.RecordBatch.from_arrays(columns, names=[*others, *made])

    done = joined.mapInArrow(run, schema)
    back = [F.col("__text" if i == at_text else f"c{i}").alias(c) for i, c in enumerate(names)]
    return done.select(*back, F.col("__n_lines").alias("n_lines"), F.col("__n_deleted").alias("n_deleted"))
