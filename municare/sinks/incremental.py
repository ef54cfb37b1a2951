"""Incremental refresh of a partitioned table from a growing source."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municare.sinks.tables import loads, replace_partitions


def offered_loads(source: DataFrame, partition: str, loaded_at: str) -> dict[object, int | None]:
    """Newest load (microseconds since 1970) of each partition of a source that keeps no ledger."""
    newest = source.groupBy(partition).agg(F.unix_micros(F.max(loaded_at)).alias("newest"))
    return {r[0]: r[1] for r in newest.collect()}  # one row per arrival period


def stale_partitions(offered: Mapping[object, int | None], have: Mapping[object, int | None]) -> list:
    """Partitions whose newest load in the source is newer than in the target, or that the
    target does not hold. One global maximum would skip, for good, a partition loaded before
    the last refresh but never materialised. Two ledgers are compared; no row is read."""

    def newer(value: object) -> bool:
        mine, theirs = have.get(value), offered[value]
        return value not in have or (theirs is not None and (mine is None or theirs > mine))

    return sorted(value for value in offered if value is not None and newer(value))


def refresh_incremental(
    source: DataFrame,
    path: str,
    build: Callable[[DataFrame], DataFrame],
    partition: str,
    loaded_at: str = "_loaded_at",
    only: str | None = None,
    aligned: bool = False,
    offered: Mapping[object, int | None] | None = None,
) -> list:
    """Rebuild the stale partitions whole, or only the one named by ``only``; returns them.

    ``offered`` is the ledger of the source (newest load of each partition), which a stored table
    keeps with its pointer; without it that is counted from the source's rows. The target's ledger says
    which load each of its partitions was built from, also of those that came out empty.

    ``build`` decides the columns: the table is read under its schema from then on, so added
    columns are NULL in partitions not rebuilt yet and dropped ones are gone. ``aligned``
    says that the source is stored by the same partitions, which makes the refresh map-only.
    A partition named by ``only`` that the source does not hold changes nothing.
    """
    spark = source.sparkSession
    if offered is None:
        seen = source if only is None else source.filter(F.col(partition) == F.lit(only))
        offered = offered_loads(seen, partition, loaded_at)
    if only is not None:
        chosen = [only] if only in offered else []
    else:
        kind = source.schema[partition].dataType
        have = {value: part.newest for value, part in loads(spark, path, partition, kind).items()}
        chosen = stale_partitions(offered, have)
    if chosen:
        fresh = build(source.filter(F.col(partition).isin(chosen)))
        named = [{partition: value} for value in chosen]
        replace_partitions(fresh, path, named, aligned, {value: offered[value] for value in chosen})
    return chosen
