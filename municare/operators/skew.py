"""Joins on a key that may own a third of the rows.

AQE splits a hot partition of a join only where both sides come straight from a shuffle; it
leaves alone a side that is an aggregate or a window on the same key. These joins spread the
hot keys themselves.

A fair share is the number of rows divided by ``shares``, by default the shuffle partitions.
A key with more than a fair share is hot, so fewer than ``shares`` keys can be hot and what
belongs to them, one row per key, may be broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SHARES = 1_000
MANY = 1 << 20
SLOT = "__slot"
SLOTS = "__slots"


def _fair_share(rows: DataFrame, shares: int | None, total: Column | None = None) -> Column:
    """Rows per share. Counting the rows of a stored table reads footers only; ``total`` says
    how else the number of rows follows from ``rows``."""
    if shares is None:
        conf = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
        shares = max(MIN_SHARES, int(conf))
    counted = F.count(F.lit(1)) if total is None else total
    return rows.agg(counted / F.lit(shares)).scalar()


def _deal(columns: Sequence[str], slots: Column) -> Column:
    """A slot that stays the same when a task is retried; the partition id in it spreads
    identical copies too."""
    return F.pmod(F.xxhash64(*columns) + F.spark_partition_id(), slots).cast("int")


def join_facts_back(
    rows: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    weight: str,
    shares: int | None = None,
    total: Column | None = None,
) -> DataFrame:
    """Join ``rows`` with facts aggregated from them, one row per key. ``weight`` is the
    number of rows behind a key. NULL is a key like any other, as in a window.

    Facts of hot keys reach their rows by broadcast. The rows of hot keys then carry a slot
    that matches no fact and scatters them over the reducers of the join that serves the
    other keys. Both fact sides read the same aggregate, which Spark computes once. ``total``,
    an aggregate over the facts, gives the number of rows without reading them again.
    """
    keys = list(keys)
    measures = [c for c in facts.columns if c not in (*keys, weight)]
    fair = _fair_share(rows, shares) if total is None else _fair_share(facts, shares, total)
    is_hot = F.col(weight) > fair

    def side(chosen: Column, tag: str, *extra: Column) -> DataFrame:
        return facts.filter(chosen).select(
            *[F.col(k).alias(f"__{tag}_key_{i}") for i, k in enumerate(keys)],
            *[F.col(m).alias(f"__{tag}_{m}") for m in measures],
            *extra,
        )

    hot = F.broadcast(side(is_hot, "hot", F.lit(True).alias("__is_hot")))
    # Always 0, but not a literal: as one it would stop being a join key.
    cold = side(~is_hot, "cold", is_hot.cast("int").alias("__cold_slot"))
    same = [rows[k].eqNullSafe(hot[f"__hot_key_{i}"]) for i, k in enumerate(keys)]
    scattered = F.lit(1) + _deal(rows.columns, F.lit(MANY))
    left = rows.join(hot, same, "left").withColumn(
        SLOT, F.when(F.col("__is_hot"), scattered).otherwise(F.lit(0))
    )
    same = [left[k].eqNullSafe(cold[f"__cold_key_{i}"]) for i, k in enumerate(keys)]
    joined = left.join(cold, [*same, left[SLOT] == cold["__cold_slot"]], "left")
    found = [
        F.when(F.col("__is_hot"), F.col(f"__hot_{m}")).otherwise(F.col(f"__cold_{m}")).alias(m)
        for m in measures
    ]
    return joined.select(*[left[c] for c in rows.columns], *found)


def _slotted(side: DataFrame, keys: Sequence[str], hot: DataFrame, slot: Column) -> DataFrame:
    names = [f"__hot_{i}" for i in range(len(keys))]
    # <=> so that NULL can be a hot key too.
    condition = [side[k].eqNullSafe(hot[n]) for k, n in zip(keys, names)]
    return side.join(hot, condition, "left").withColumn(SLOT, slot).drop(SLOTS, *names)


def spread_lookup(
    rows: DataFrame,
    table: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    shares: int | None = None,
) -> DataFrame:
    """Left join like ``left_lookup`` for a table too large to broadcast.

    Rows of a hot key, NULL included, are dealt to as many slots as the key has fair shares,
    and the key's rows in the table are repeated once per slot: fewer than twice ``shares``
    rows more where the table holds each key once.
    """
    keys = list(on)
    names = {key: f"__key_{i}" for i, key in enumerate(on.values())}
    fair = _fair_share(rows, shares)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot = F.broadcast(
        counts.filter(F.col("__n") > fair).select(
            *[F.col(k).alias(f"__hot_{i}") for i, k in enumerate(keys)],
            F.ceil(F.col("__n") / fair).cast("int").alias(SLOTS),
        )
    )
    dealt = F.when(F.col(SLOTS).isNotNull(), _deal(rows.columns, F.col(SLOTS)))
    repeated = F.explode(F.sequence(F.lit(0), F.coalesce(SLOTS, F.lit(1)) - 1))
    left = _slotted(rows, keys, hot, dealt.otherwise(F.lit(0)))
    side = table.select(
        *[F.col(k).alias(n) for k, n in names.items()],
        *[F.col(c).alias(name) for c, name in take.items()],
    )
    right = _slotted(side, list(names.values()), hot, repeated)
    right = right.withColumnRenamed(SLOT, "__table_slot")
    condition = [left[c] == right[names[k]] for c, k in on.items()]
    condition.append(left[SLOT] == right["__table_slot"])
    return left.join(right, condition, "left").drop(SLOT, "__table_slot", *names.values())
