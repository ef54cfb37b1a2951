"""Exact distinct counts that merge: bitmaps per group, kept for every load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITMAP = "__bucket", "__bitmap"


def distinct_state(rows: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """(group, bucket, bitmap): which whole numbers ``value`` takes in each group, 32,768 to a bitmap of
    4 kB. Bitmaps are built map-side, so a hot group crosses the shuffle once per task and bucket.
    NULL counts as no value."""
    held = rows.filter(F.col(value).isNotNull())
    of = held.groupBy(*group, F.bitmap_bucket_number(F.col(value)).alias(BUCKET))
    return of.agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(value))).alias(BITMAP))


def distinct_counts(state: DataFrame, group: Sequence[str], out: str) -> DataFrame:
    """Distinct values per group over any number of states: the bitmaps of a bucket are joined by or, so a
    value that came with several loads counts once. The rows behind the states are not read again."""
    merged = state.groupBy(*group, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))
    return merged.groupBy(*group).agg(F.sum(F.bitmap_count(BITMAP)).alias(out))
