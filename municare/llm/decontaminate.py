"""Benchmark passages in training texts: found by their windows, then removed with or without the text.

A window is ten consecutive words of a benchmark item; an item of fewer words, but not none, is one
window. Words are runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased.

Everything is DataFrame expressions. A text is cut once; the hash of the words from each position on
is looked up in a broadcast set of window hashes, and the words themselves are compared at once, in
the same pass. A set too large for one broadcast is looked up in several passes over the texts, each
with a part of it. Only hits are shuffled.

Defined results: a text that is null or holds no word has no words and no hits; null item texts
have no windows; repeated rows of a text are judged alike, each on its own; an item id that repeats
counts once, a null id as an empty string. Columns of the texts other than the id are not read, so
clashing names do not matter. Without windows nothing is hit.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from municare.llm.common import stored
from municare.llm.merkle import LOWER, UPPER

WINDOW = 10
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of lower-cased text
PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # of any text
# Windows of one broadcast, and bytes of their words. A hash set of this many takes about 200 MB.
MOST_WINDOWS = 1_000_000
MOST_BYTES = 128 << 20


def words_of(text: Column) -> Column:
    """Words of a text in order; none of a null text."""
    cut = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BREAKS)
    return F.array_remove(cut, "")


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """(item string, gram array of words): distinct windows of each item."""
    words = benchmark.select(
        F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("item"),
        words_of(F.col(f"`{text}`")).alias("words"),
    ).filter("size(words) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(1)))
    placed = words.select("item", "words", F.explode(starts).alias("at"))
    return placed.select("item", F.slice("words", F.col("at"), F.lit(size)).alias("gram")).distinct()


def _hashes(words: str) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _from_each(of: Column, size: int) -> Column:
    """The hash of the ``size`` words from each place on. At the end of a text a slice is shorter: it
    is then looked up as the shorter window it is."""
    places = F.when(F.size(of) > 0, F.sequence(F.lit(1), F.size(of))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.slice(of, i, F.lit(size))))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: an expression over a column is otherwise
    put in its place, here once for every word."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hits(
    docs: DataFrame,
    grams: DataFrame,
    keep: list[str],
    text: str = "text",
    most_windows: int = MOST_WINDOWS,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """(row, keep columns, n_words, low, high, gram): a row per text with nulls, and one for each
    place, words low to high - 1, where a window of ``grams`` (gram, distinct) occurs.

    ``row`` numbers the texts. The result is stored, so that the numbers are the same for all who
    read it. Passes over the texts: one for each ``most_windows`` windows or ``most_bytes`` of them.
    """
    sized = grams.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length(F.array_join("gram", " "))), F.lit(0)).alias("bytes"),
        F.array_sort(F.collect_set(F.size("gram"))).alias("sizes"),  # at most as many as the window has words
    ).first()
    passes = max(1, math.ceil(sized["n"] / most_windows), math.ceil(sized["bytes"] / most_bytes))
    known = grams.select(_hashes("gram").alias("__hashes"), F.col("gram").alias("__gram"))
    known = known.select(F.xxhash64("__hashes").alias("__known"), "__gram")

    cut = docs.select(
        F.monotonically_increasing_id().alias("row"), *[F.col(f"`{c}`") for c in keep],
        words_of(F.col(f"`{text}`")).alias("__words"),
    )
    sizes = sized["sizes"]
    none = F.array(F.lit(None).cast("long"))  # stands for the text itself, after all its windows
    looked = _let(_hashes("__words"), lambda of: F.concat(*[_from_each(of, size) for size in sizes], none))
    cut = cut.select("*", F.size("__words").alias("n_words"), looked.alias("__looked"))

    parts = []
    for part in range(passes):
        some = known if passes == 1 else known.filter(F.pmod("__known", F.lit(passes)) == part)
        each = cut.select("row", *keep, "n_words", "__words", F.posexplode("__looked").alias("__i", "__hash"))
        is_text = F.col("__i") == F.col("n_words") * len(sizes)
        at = F.when(~is_text, F.col("__i") % F.col("n_words")).alias("low")
        here = F.slice("__words", F.col("__i") % F.nullif("n_words", F.lit(0)) + 1, F.size("__gram")) == F.col("__gram")
        same = (F.col("__hash") == F.col("__known")) & here
        met = each.join(F.broadcast(some), same, "left")
        wanted = F.col("__gram").isNotNull() | (is_text if part == 0 else F.lit(False))
        parts.append(met.filter(wanted).select(
            "row", *keep, "n_words", at, (at + F.size("__gram")).alias("high"), F.col("__gram").alias("gram")
        ))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return stored(found, "hits")


def judge(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", **limits: int
) -> DataFrame:
    """Per text: id, n_words, n_hit (words inside any occurrence), n_items and items (sorted as
    strings) whose windows occur, contaminated."""
    grams = stored(windows(benchmark), "windows")
    found = hits(docs, grams.select("gram").distinct(), [id_column], text, **limits)
    of = found.filter("gram is null").select("row", f"`{id_column}`", F.col("n_words").cast("long").alias("n_words"))
    places = found.filter("gram is not null")

    covered = spans(places.select("row", "low", "high")).groupBy("row").agg(
        F.sum(F.col("high") - F.col("low")).cast("long").alias("n_hit")
    )
    # Windows of a text once each, then the items that share them, each once.
    items = places.select("row", "gram").distinct().join(grams, "gram").select("row", "item").distinct()
    items = items.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    told = covered.join(items, "row")
    none = F.array().cast("array<string>")
    return of.join(told, "row", "left").select(
        id_column,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def spans(places: DataFrame) -> DataFrame:
    """(row, low, high) of overlapping or touching places joined to disjoint ones. The places of one
    text pass a window in order, so none has to be held."""
    order = Window.partitionBy("row").orderBy("low", "high")
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = places.withColumn("__opens", F.coalesce(F.col("low") > reach, F.lit(True)).cast("int"))
    numbered = opened.withColumn("__span", F.sum("__opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("row", "__span").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("__span")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", remove: str = "spans", **limits: int
) -> DataFrame:
    """The texts without what they share with the benchmark; all columns of ``docs``.

    ``remove`` is ``documents`` (hit rows go) or ``spans`` (hit words go with the characters before
    them, everything else stays as it is). Texts that are the same are treated the same. Texts and
    decisions meet by a digest of the text; decisions are one row per hit text.
    """
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    names = docs.columns
    at = f"c{names.index(text)}"
    named = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    named = named.withColumn("__key", F.md5(F.col(at).cast("binary")))
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    grams = stored(windows(benchmark).select("gram").distinct(), "windows")
    found = hits(named, grams, ["__key"], at, **limits).filter("gram is not null")
    firsts = found.groupBy("__key").agg(F.min("row").alias("__first"))  # one of the rows of a text
    placed = found.join(firsts, "__key").filter("row = __first")
    whole = spans(placed.select("row", "low", "high"))
    gone = whole.groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("__gone"))
    gone = firsts.join(gone, F.col("row") == F.col("__first")).select(F.col("__key").alias("__hit"), "__gone")
    gone = stored(gone, "gone")
    same = F.col("__key") == F.col("__hit")
    if remove == "documents":
        return named.join(gone, same, "left_anti").select(*back)
    pieces = F.regexp_extract_all(F.col(at), F.lit(PIECE), F.lit(0))
    inside = lambda i: F.exists("__gone", lambda s: (s["low"] <= i) & (i < s["high"]))
    left = F.array_join(F.filter(pieces, lambda _, i: ~inside(i)), "")
    tail = F.regexp_extract(F.col(at), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\z", 0)
    cleaned = F.when(F.col("__gone").isNull(), F.col(at)).otherwise(F.concat(left, tail))
    return named.join(gone, same, "left").withColumn(at, cleaned).select(*back)
