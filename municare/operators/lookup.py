"""Joins to code tables and dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20


def bounded(
    table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Mark a lookup for broadcast only once its rows and its bytes have been counted.

    A larger table comes back unmarked: the join then shuffles both sides and AQE splits
    the hot keys. The rows are counted first, which for a stored table reads footers only.
    """
    if table.count() > max_rows:
        return table
    weight = F.sum(F.octet_length(F.to_json(F.struct(*table.columns))))
    size = table.agg(weight).first()[0] or 0
    return F.broadcast(table) if size <= max_bytes else table


def left_lookup(
    rows: DataFrame,
    table: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
) -> DataFrame:
    """Add columns of a code table. ``on`` maps row column -> table key, ``take`` maps
    table column -> output name. Unknown codes keep their row and get NULL."""
    keys = {key: f"__key_{i}" for i, key in enumerate(on.values())}
    side = table.select(
        *[F.col(key).alias(alias) for key, alias in keys.items()],
        *[F.col(c).alias(name) for c, name in take.items()],
    )
    condition = [rows[column] == side[keys[key]] for column, key in on.items()]
    return rows.join(side, condition, "left").drop(*keys.values())


def role_lookup(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    value: str,
    roles: Mapping[str, str],
) -> DataFrame:
    """Join the same dimension once per role: row column -> output column."""
    for column, output in roles.items():
        rows = left_lookup(rows, dimension, {column: key}, {value: output})
    return rows


def keep_scope(rows: DataFrame, scope: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Inner join to a scope relation whose key is unique; only row columns survive."""
    side = scope.select(*[F.col(k).alias(f"__scope_{i}") for i, k in enumerate(on.values())])
    condition = [rows[c] == side[f"__scope_{i}"] for i, c in enumerate(on)]
    return rows.join(side, condition, "inner").select(*[rows[c] for c in rows.columns])


def membership_flag(
    rows: DataFrame, members: DataFrame, on: Mapping[str, str], name: str
) -> DataFrame:
    """TRUE where the row's key is listed, FALSE otherwise."""
    listed = members.select(*on.values()).distinct().withColumn("__listed", F.lit(True))
    found = left_lookup(rows, listed, on, {"__listed": "__listed"})
    return found.withColumn(name, F.col("__listed").isNotNull()).drop("__listed")


def aggregate_then_label(
    rows: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Column],
    code: str,
    table: DataFrame,
    table_key: str,
    take: Mapping[str, str],
) -> DataFrame:
    """Aggregate on the code first and fetch its label for the few result rows. Same result
    as labelling every row, because the label depends on the code alone."""
    totals = rows.groupBy(*keys).agg(*measures)
    return left_lookup(totals, table, {code: table_key}, take)
