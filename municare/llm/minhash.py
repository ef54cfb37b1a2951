"""Near-duplicate documents by circulant MinHash.

Method: a shingle is a number below 2**32 (the upper half of its hash, sent through a first
permutation). Coordinate k of the signature is the least value that a second permutation
takes on the shingles shifted circularly by k, so two permutations serve for every coordinate.
Documents that agree on all coordinates of a band are candidates; each candidate pair that
decides about a component is confirmed on the full shingle sets.

Links are only needed as far as they join components, and no pair that could join two is left
out. Documents with equal sets become one class, so a group of exact copies is one node. All
classes that share a bucket are compared with its hub, the class that shares most buckets, and
most of a large group of near copies is then one component. What is left are pairs of classes
of one hub that are still apart. In groups of at most FEW classes they are compared. In larger
ones the shingles shared with the hub bound what two classes can share: a pair can only be
similar enough if the bound says so and it either holds without shingles foreign to the hub,
or both hold such a shingle; these pairs are found by joining on the foreign shingles, where
large groups get a hub of their own first.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from municare.llm.common import is_empty, map_texts, per_worker, stored
from municare.llm.components import components
from municare.llm.shingles import Shingler

# A pair with Jaccard 0.75 shares no band with probability (1 - 0.75**4)**32 = 5e-6.
BANDS = 32
ROWS = 4
PERCENT = 75
FEW = 16  # classes of a group whose pairs are listed without further search
_BLOCK = 1024


def _mixed(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A permutation of the numbers below 2**32, applied in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(first)
    x ^= x >> np.uint32(13)
    x *= np.uint32(second)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray, length: int) -> np.ndarray:
    """``length`` coordinates, uint32, of a set that is not empty."""
    start = _mixed((shingles >> np.uint64(32)).astype(np.uint32), 0x7FEB352D, 0x846CA68B)
    shifts = np.arange(1, length + 1, dtype=np.uint32)[:, None]
    least = np.full(length, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(start), _BLOCK):
        turned = start[None, at : at + _BLOCK] + shifts
        np.minimum(least, _mixed(turned, 0x85EBCA6B, 0xC2B2AE35).min(axis=1), out=least)
    return least


def band_hashes(coordinates: np.ndarray, bands: int) -> np.ndarray:
    rows = coordinates.reshape(bands, -1).astype(np.uint64)
    total = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(rows.shape[1]):
        total = (total ^ (total >> np.uint64(31)) ^ rows[:, i]) * np.uint64(0xD6E8FEB86659FD93)
    total ^= total >> np.uint64(32)
    return total.view(np.int64)


def _signed(texts, shingler: Shingler, bands: int, rows: int) -> dict[str, pa.Array]:
    sizes, keys, banded = [], [], []
    for text in texts:
        found = shingler(text)
        sizes.append(len(found))
        if len(found):
            keys.append(xxhash.xxh3_128_digest(found.tobytes()))
            banded.append(band_hashes(signature(found, bands * rows), bands))
        else:
            keys.append(None)
            banded.append(None)
    return {
        "__n": pa.array(sizes, pa.int64()),
        "__key": pa.array(keys, pa.binary()),
        "__bands": pa.array(banded, pa.list_(pa.int64())),
    }


def _sets(texts, shingler: Shingler) -> dict[str, pa.Array]:
    found = [shingler(t) for t in texts]
    return {
        "__set": pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64())),
        "__key": pa.array([xxhash.xxh3_128_digest(f.tobytes()) for f in found], pa.binary()),
    }


def _full_sets(documents: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, __set) of the classes in ``nodes``, made from whole texts."""
    wanted = classes.select("node", F.col("id").alias("of"), F.col("__key").alias("key"))
    wanted = stored(wanted.join(nodes, "node"), "wanted")
    # One plan at every size: texts and classes meet by a sorted merge.
    texts = documents.join(wanted.hint("merge"), F.col("__id") == F.col("of"), "left_semi")
    worker = per_worker(documents.sparkSession, Shingler)
    sets = map_texts(texts, ["__id"], "__text", lambda t: _sets(t, worker()), "__set array<bigint>, __key binary")
    # An id may repeat with the same set, of which one is enough, or with others, which are nodes of their own.
    sets = sets.join(wanted, (F.col("__id") == F.col("of")) & (F.col("__key") == F.col("key")))
    return stored(sets.dropDuplicates(["node"]).select("node", "__set"), "sets")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b, a_size, b_size) of a stored table with ``shared``, stored."""
    left = sets.select(F.col("node").alias("a"), F.col("__set").alias("__left"))
    right = sets.select(F.col("node").alias("b"), F.col("__set").alias("__right"))
    joined = pairs.join(right, "b").join(left, "a")
    joined = joined.withColumn("shared", F.size(F.array_intersect("__left", "__right")).cast("long"))
    return stored(joined.drop("__left", "__right"), "compared")


def _similar(shared: Column, a_size: Column, b_size: Column, percent: int) -> Column:
    return F.lit(100) * shared >= F.lit(percent) * (a_size + b_size - shared)


def _size_band(percent: int) -> Column:
    """Sizes of similar sets lie in the same band or in neighbouring ones; a little wider than need be,
    against rounding."""
    return F.floor(F.log(F.col("size").cast("double")) / F.lit(math.log(100 / percent) * 1.0001)).cast("int")


def _side(groups: DataFrame, key: list[str], name: str, *more: str) -> DataFrame:
    columns = ["node", "size", "component", "with_hub", "outside"]
    return groups.select(*key, "__band", *more, *[F.col(c).alias(f"{name}_{c}") for c in columns])


def _listed(groups: DataFrame, key: list[str], percent: int, below: str | None = None, foreign: bool = True) -> DataFrame:
    """Distinct pairs (a, b, a_size, b_size) of a group that lie in different components and may be
    similar. They share at most the lower of their parts within the hub and, if ``foreign``
    shingles may agree, the lower of their numbers of shingles ``outside`` it that come into
    question. The smaller of the two is smaller than the column ``below``, if given.

    One of the two lies outside the ``main`` component of its group, the one with most members. So only
    the others meet all members, of a size that allows similarity: many near copies and a few strangers
    give pairs in proportion to the copies, and members of the main component never meet each other.
    """
    groups = groups.withColumn("__band", _size_band(percent))
    others = groups.filter("component != main")
    nearby = F.array(*[F.col("__band") + step for step in (-1, 0, 1)])
    x = _side(others.withColumn("__band", F.explode(nearby)), key, "x", *([below] if below else []))
    pairs = x.join(_side(groups, key, "y"), [*key, "__band"]).filter("x_component != y_component and x_node != y_node")
    col = F.col
    if below is not None:
        pairs = pairs.filter(F.least("x_size", "y_size") < col(below))
    most = F.least("x_with_hub", "y_with_hub")
    if foreign:
        most = most + F.least("x_outside", "y_outside")
    pairs = pairs.filter(_similar(most, col("x_size"), col("y_size"), percent))
    swap = col("x_node") > col("y_node")
    ordered = [
        F.when(swap, col(f"y_{c}")).otherwise(col(f"x_{c}")).alias(f"a{n}") for c, n in (("node", ""), ("size", "_size"))
    ] + [F.when(swap, col(f"x_{c}")).otherwise(col(f"y_{c}")).alias(f"b{n}") for c, n in (("node", ""), ("size", "_size"))]
    # The order of _with_hub, as unions go by position.
    return pairs.select(*ordered).select("a", "b", "a_size", "b_size").distinct()


def _open_groups(groups: DataFrame, key: list[str]) -> DataFrame:
    """(key, n, main): members of the groups that lie in several components, and the component with
    most of them. Members are counted per component first, so a hot group crosses in few rows."""
    parts = groups.groupBy(*key, "component").agg(F.count(F.lit(1)).alias("__n"))
    largest = F.max(F.struct("__n", -F.col("component"), "component"))["component"]
    opened = parts.groupBy(*key).agg(F.sum("__n").alias("n"), largest.alias("main"), F.count(F.lit(1)).alias("__parts"))
    return stored(opened.filter("__parts > 1").drop("__parts"), "open")


def _still_apart(groups: DataFrame, key: list[str], found: DataFrame) -> DataFrame:
    """Groups with members in several components, with the component of each member, the number of
    members and the main component."""
    labels = found.select(F.col("node").alias("__node"), F.col("component").alias("__component"))
    groups = groups.drop("component", "n", "main").join(labels, F.col("node") == F.col("__node"), "left")
    groups = groups.withColumn("component", F.coalesce("__component", "node")).drop("__node", "__component")
    groups = stored(groups, "labelled")
    return stored(groups.join(_open_groups(groups, key), key), "apart")


def near_duplicates(
    documents: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
    percent: int = PERCENT,
) -> DataFrame:
    """Per row of ``documents``: id, n_shingles, component_id, kept.

    Texts that are null, empty or without words have no shingles and are their own component.
    Rows without an id take part in no link: component_id null, kept true. Rows that repeat an
    id and its shingles are copies of one document and kept or dropped together. Rows that
    repeat an id with other shingles are documents of their own; a component has the name of its
    smallest id, and rows of that id are kept. Other columns are not read.
    """
    return judged(documents, id, text, bands, rows, percent).drop("__text_key", "__stays")


def judged(
    documents: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
    percent: int = PERCENT,
) -> DataFrame:
    """``near_duplicates`` with ``__text_key``, the xxhash64 of the text of the row, and ``__stays``: like
    kept, but of rows that repeat an id with different texts of one component only one set stays."""
    slim = documents.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    worker = per_worker(documents.sparkSession, Shingler)
    signed = map_texts(
        slim.withColumn("__text_key", F.xxhash64("__text")), ["__id", "__text_key"], "__text",
        lambda t: _signed(t, worker(), bands, rows),
        "__n bigint, __key binary, __bands array<bigint>",
    )
    signed = stored(signed, "signed")
    # The partial minimum leaves one row per class and task before the shuffle.
    classes = signed.filter("__id is not null and __key is not null").groupBy("__key")
    classes = classes.agg(
        F.min("__id").alias("id"),
        F.max("__n").alias("__size"),
        F.min_by("__bands", "__id").alias("__bands"),
    )
    # A class is a node by a number of its own, as an id may repeat with other texts.
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    members = classes.select(F.explode("__bands").alias("band"), "node", F.col("__size").alias("size"))
    shared = members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Buckets of one class end here.
    buckets = stored(members.join(stored(shared, "shared"), "band"), "buckets")

    found = components(_links(buckets, slim, classes, percent))

    linked = stored(found.join(classes.select("node", "id", "__key"), "node"), "linked")
    least = linked.groupBy("component").agg(F.min(F.struct("id", F.col("__key").alias("key"))).alias("least"))
    linked = linked.join(stored(least, "least"), "component").select(F.col("node").alias("__node"), "least")
    named = classes.join(stored(linked, "named"), F.col("node") == F.col("__node"), "left").select(
        F.col("__key").alias("__class"),
        F.coalesce("least.id", "id").alias("__component"),
        F.coalesce("least.key", "__key").alias("__first"),
    )
    result = signed.join(stored(named, "named"), F.col("__key") == F.col("__class"), "left")
    component = F.when(F.col("__id").isNotNull(), F.coalesce("__component", "__id"))
    first = F.col("__id").isNull() | F.col("__key").eqNullSafe(F.col("__first"))
    return result.select(
        F.col("__id").alias(id),
        F.col("__n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("__id").eqNullSafe(component).alias("kept"),
        "__text_key",
        (F.col("__id").eqNullSafe(component) & first).alias("__stays"),
    )


def _links(buckets: DataFrame, documents: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that give the components of all similar pairs in ``buckets``."""
    sets = _full_sets(documents, classes, buckets.select("node").distinct())
    weight = stored(buckets.groupBy("node").agg(F.sum("n").alias("weight")), "weight")
    ranked = stored(buckets.drop("n").join(weight, "node"), "ranked")
    best = F.max(F.struct("weight", -F.col("node"), "node", "size")).alias("best")
    named = [F.col("best.node").alias("hub"), F.col("best.size").alias("hub_size")]
    hubs = stored(ranked.groupBy("band").agg(best).select("band", *named), "hubs")
    groups = ranked.join(hubs, "band").filter("node != hub").select("hub", "hub_size", "node", "size", "weight")
    groups = stored(groups.distinct(), "groups")

    pairs = stored(_with_hub(groups), "pairs")
    compared = _compared(pairs, sets)
    links = _linked(compared, percent)
    shared = compared.select(F.col("a").alias("hub"), F.col("b").alias("node"), F.col("shared").alias("with_hub"))
    groups = groups.join(shared, ["hub", "node"]).withColumn("outside", F.col("size") - F.col("with_hub"))
    groups = stored(groups, "groups")
    groups = _still_apart(groups, ["hub"], components(links))
    rest = _listed(groups.filter(F.col("n") <= FEW), ["hub"], percent)
    large = groups.filter(F.col("n") > FEW)
    # Without foreign shingles in common the smaller of two classes has to be smaller than the
    # hub, or one of the two would be similar to the hub whenever the pair is.
    rest = rest.union(_listed(large, ["hub"], percent, "hub_size", foreign=False))

    foreign = large.join(sets.select("node", F.col("__set").alias("own")), "node")
    foreign = foreign.join(sets.select(F.col("node").alias("hub"), F.col("__set").alias("hubs")), "hub")
    foreign = foreign.withColumn("shingle", F.explode(F.array_except("own", "hubs"))).drop("own", "hubs", "n", "main", "outside")
    foreign = stored(foreign, "foreign")
    key = ["hub", "shingle"]
    many = _open_groups(foreign, key)
    # The rarest first: of the shingles that two classes share, the first one has all others
    # behind it, so what is left from a shingle on bounds a pair that is found by it.
    order = Window.partitionBy("hub", "node").orderBy(F.desc("n"), F.desc("shingle"))
    foreign = foreign.join(many, key).withColumn("outside", F.row_number().over(order).cast("long"))
    foreign = stored(foreign, "foreign")
    rest = rest.union(_listed(foreign.filter(F.col("n") <= FEW), key, percent))

    large = foreign.filter(F.col("n") > FEW)
    hubs = stored(large.groupBy(*key).agg(best).select(*key, F.col("best.node").alias("top"), F.col("best.size").alias("top_size")), "hubs")
    tops = large.join(hubs, key).filter("node != top")
    tops = tops.select(F.col("top").alias("hub"), F.col("top_size").alias("hub_size"), "node", "size").distinct()
    rest = stored(rest.union(_with_hub(tops)).distinct(), "rest")
    if is_empty(rest):
        return links
    links = links.union(_linked(_compared(rest, sets), percent))
    last = _still_apart(large, key, components(links))
    last = _listed(last, key, percent).join(rest, ["a", "b", "a_size", "b_size"], "left_anti")
    last = stored(last, "last")
    if is_empty(last):
        return links
    return links.union(_linked(_compared(last, sets), percent))


def _with_hub(groups: DataFrame) -> DataFrame:
    return groups.select(F.col("hub").alias("a"), F.col("node").alias("b"), F.col("hub_size").alias("a_size"), F.col("size").alias("b_size"))


def _linked(compared: DataFrame, percent: int) -> DataFrame:
    return compared.filter(_similar(F.col("shared"), F.col("a_size"), F.col("b_size"), percent)).select("a", "b")
