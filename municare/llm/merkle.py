"""A Merkle manifest of a table: leaves, parent-linked nodes, and proofs that climb from each leaf.

Leaves of a group lie in order; every 8 consecutive nodes of a level (the last run: fewer) become
one node until one is left, the group's subroot. The subroots, ordered by group, become the root
in the same way. Built levels are stored as node rows that name their parent, and a recursive
query climbs from all leaves at once, one level a round.

Defined results: a missing value counts as ``-`` in the leaf; rows without a group form a group
before all others; rows without an order value lie first; rows that are equal in everything are
leaves of their own, and any of them may lie first as they cannot be told apart. A lone leaf is its
group's subroot, a lone subroot the root. An empty table has no leaves and no root.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from municare.llm.common import is_empty, stored, with_running_sum

RUN = 8
DIGEST = 32  # bytes
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = -1  # number of the tree over the subroots; groups count from 0


@dataclass(frozen=True)
class Manifest:
    """``leaves``: g, at (place in its group), the kept columns, leaf, claim, parent (up_g, up_level,
    up_at) and place there. ``nodes``: g, level, at, digest, kids (digests of its children), parent."""

    leaves: DataFrame
    nodes: DataFrame
    keep: tuple[str, ...]


def hashed(kids: Column) -> Column:
    """SHA-256 over digests as lowercase hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(kids)), 256))


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 over the values: ``-`` where missing, else UTF-8 byte count, ``:``, value."""
    parts = []
    for value in values:
        text = value.cast("string")
        told = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(told, F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def build(
    rows: DataFrame,
    columns: Sequence[str],
    group: str,
    order: str,
    claims: Mapping[str, Column] | None = None,
) -> Manifest:
    """Store leaves and nodes of ``rows``. ``claims`` names columns whose value a later reader
    claims to be another one; the leaf of those claims is kept beside the true leaf.

    One pass hashes the texts; what is sorted, numbered and grouped afterwards is a few dozen bytes
    a row. The order is cut into ranges, so a group with most rows is numbered by many tasks.
    """
    true = [F.col(f"`{c}`") for c in columns]
    claimed = [(claims or {}).get(c, F.col(f"`{c}`")) for c in columns]
    slim = rows.select(
        F.col(f"`{group}`").alias("__group"),
        F.col(f"`{order}`").alias(order),
        leaf_digest(true).alias("leaf"),
        (leaf_digest(claimed) if claims else F.lit(None).cast("binary")).alias("claim"),
        F.lit(1).cast("long").alias("__one"),
    )
    slim = stored(slim.withColumn("claim", F.coalesce("claim", "leaf")), "leaves")
    within = [F.col(order).asc_nulls_first(), F.col("leaf"), F.col("claim")]
    numbered = with_running_sum(slim, ["__group"], within, "__one", "__n", "leaves")

    groups = slim.groupBy("__group").agg(F.count(F.lit(1)).alias("n")).withColumn("__one", F.lit(1).cast("long"))
    groups = with_running_sum(groups, [], [F.col("__group").asc_nulls_first()], "__one", "__g", "groups")
    groups = stored(groups.select(F.col("__group").alias("__of"), "n", (F.col("__g") - 1).alias("g")), "groups")
    count = groups.count()

    leaves = numbered.join(groups, F.col("__group").eqNullSafe(F.col("__of")))
    leaves = leaves.select("g", (F.col("__n") - 1).alias("at"), order, "leaf", "claim", "n")
    leaves = stored(_linked(leaves.withColumn("level", F.lit(0)), count), "leaves")

    floor = leaves.select("g", "level", "at", "n", F.col("leaf").alias("digest"))
    built = _levels(floor, count)
    floors = [floor, *built]
    if count > 1:
        tops = [f.filter("n = 1").select("g", "digest") for f in floors]
        tops = reduce(DataFrame.union, tops).select(
            F.lit(TOP).cast("long").alias("g"), F.lit(0).alias("level"), F.col("g").alias("at"),
            F.lit(count).cast("long").alias("n"), "digest",
        )
        built += _levels(stored(tops, "subroots"), count)
    if not built:  # at most one leaf: a table of nodes without rows
        built = [stored(_parents(floor.filter("false"), count), "nodes")]
    return Manifest(leaves, reduce(DataFrame.union, built), (order,))


def _levels(floor: DataFrame, groups: int) -> list[DataFrame]:
    """The levels above ``floor``, each stored, until no tree has two nodes on one."""
    built: list[DataFrame] = []
    while True:
        floor = stored(_parents(floor, groups), "nodes")
        if is_empty(floor):
            return built
        built.append(floor)


def _parents(floor: DataFrame, groups: int) -> DataFrame:
    """One node for each run of a level; n is the number of nodes of its tree on its level."""
    runs = floor.filter("n > 1").groupBy(
        "g", (F.col("level") + 1).alias("level"), F.expr(f"at div {RUN}").alias("at"),
        F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n"),
    )
    listed = F.array_sort(F.collect_list(F.struct(F.col("at").alias("of"), "digest")))
    nodes = runs.agg(listed.alias("run")).withColumn(
        "kids", F.unhex(F.array_join(F.transform("run", lambda k: F.hex(k["digest"])), ""))
    )
    return _linked(nodes.select("g", "level", "at", "n", "kids", hashed(F.col("kids")).alias("digest")), groups)


def _linked(rows: DataFrame, groups: int) -> DataFrame:
    """Name the parent of each node and the place among its children; the root has none."""
    inner, top = F.col("n") > 1, (F.col("n") == 1) & (F.col("g") != TOP) & F.lit(groups > 1)
    return rows.withColumns(
        {
            "up_g": F.when(inner, F.col("g")).when(top, F.lit(TOP).cast("long")),
            "up_level": F.when(inner, F.col("level") + 1).when(top, F.lit(1)),
            "up_at": F.when(inner, F.expr(f"at div {RUN}")).when(top, F.expr(f"g div {RUN}")),
            "place": F.when(inner, F.expr(f"cast(at % {RUN} as int)")).when(top, F.expr(f"cast(g % {RUN} as int)")),
        }
    )


# A row of the climb is one step of one leaf: what it has folded so far, and the siblings it met at
# that step. The siblings of all steps together are put in order afterwards, so a step carries only its own.
_CLIMB = f"""
with recursive climb(g, at, step, up_g, up_level, up_at, place, folded, siblings, subroot, root) as (
  select g, at, 0, up_g, up_level, up_at, place, claim, cast(null as binary),
         if(n = 1, leaf, cast(null as binary)), if(up_at is null, leaf, cast(null as binary))
  from {{leaves}}
  union all
  select g, at, step + 1, up_g, up_level, up_at, place,
         unhex(sha2(lower(hex(concat(before, folded, after))), 256)), concat(before, after), subroot, root
  from (select c.g, c.at, c.step, c.folded, n.up_g, n.up_level, n.up_at, n.place,
               substring(n.kids, 1, {DIGEST} * c.place) as before,
               substring(n.kids, {DIGEST} * c.place + {DIGEST + 1}) as after,
               if(n.n = 1 and n.g != {TOP}, n.digest, cast(null as binary)) as subroot,
               if(n.up_at is null, n.digest, cast(null as binary)) as root
        from climb c join {{nodes}} n on c.up_at = n.at and c.up_level = n.level and c.up_g = n.g))
select * from climb"""


def prove(manifest: Manifest) -> DataFrame:
    """Per leaf: the order column, leaf, subroot, root, proof (hash of its siblings from bottom to
    top, each level left to right), folded_root (climbed from the claimed leaf) and verified.

    A round joins the steps of one level with the nodes above by their key; a key serves at most 8
    nodes below. The levels are as many as the logarithm of the largest group.
    """
    spark = manifest.leaves.sparkSession
    with _unbounded_recursion(spark):
        steps = spark.sql(_CLIMB, leaves=manifest.leaves, nodes=manifest.nodes)
        # The leaf's own columns join in here as its step before the first: they need not climb.
        columns = ["g", "at", "step", "folded", "siblings", "subroot", "root"]
        nothing = {c: F.lit(None).cast(t) for c, t in manifest.leaves.select(*manifest.keep, "leaf").dtypes}
        own = manifest.leaves.select(
            "g", "at", F.lit(-1).alias("step"), *[F.lit(None).cast("binary").alias(c) for c in columns[3:]],
            *manifest.keep, "leaf",
        )
        steps = steps.select(*columns).withColumns(nothing).unionByName(own)
        path = F.array_sort(F.collect_list(F.when(F.col("siblings").isNotNull(), F.struct("step", "siblings"))))
        met = steps.groupBy("g", "at").agg(
            *[F.max(c).alias(c) for c in (*manifest.keep, "leaf", "subroot", "root")],
            F.max_by("folded", "step").alias("folded_root"),
            path.alias("path"),
        )
        siblings = F.array_join(F.transform("path", lambda s: F.lower(F.hex(s["siblings"]))), "")
        told = met.withColumn("proof", F.unhex(F.sha2(siblings, 256)))
        told = stored(told.select(*manifest.keep, "leaf", "subroot", "root", "proof", "folded_root"), "proofs")
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


@contextmanager
def _unbounded_recursion(spark: SparkSession) -> Iterator[None]:
    """Spark stops a recursive query at a number of rows unless told otherwise; this one ends by
    itself, at the root."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def lowered(text: str) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(F.col(text), UPPER, LOWER)
