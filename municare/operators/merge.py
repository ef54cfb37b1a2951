"""Upsert and partition replacement as plain relational expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from municare.operators.history import latest_per_key


def upsert_rows(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], newest_first: Sequence[str]
) -> DataFrame:
    """Upsert by natural key: the batch replaces every column of the rows it names, and the
    newest of its own versions wins. ``existing`` holds each key once, so the anti-join has
    no hot key, and the batch is reduced to one row per key before it is shuffled."""
    latest = latest_per_key(batch, keys, newest_first)
    kept = existing.join(latest.select(*keys), list(keys), "left_anti")
    return kept.select(*existing.columns).unionByName(latest)


def keep_other_partitions(existing: DataFrame, batch: DataFrame, replaced: Column) -> DataFrame:
    """Partition replacement: existing rows outside the replaced partitions, plus the batch.
    An empty batch therefore empties the partition. A NULL partition value is never replaced."""
    kept = existing.filter(~replaced | replaced.isNull())
    return kept.unionByName(batch)
