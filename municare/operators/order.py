"""Running totals along a sort order that no single task could hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from municare.session import shared_folder

RANGE = "__range"


def in_ranges(rows: DataFrame, order: Sequence[Column], purpose: str) -> DataFrame:
    """The rows cut into consecutive ranges of ``order``, numbered in ``__range`` and stored, so that
    all who read them see the same ranges. Equal rows are in one range."""
    ranged = rows.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id())
    path = shared_folder(rows.sparkSession, purpose)
    ranged.write.parquet(path)
    return rows.sparkSession.read.schema(ranged.schema).parquet(path)


def running_sum(rows: DataFrame, order: Sequence[Column], value: Column, out: str, purpose: str) -> DataFrame:
    """Inclusive running sum of ``value``; rows that ``order`` leaves equal must not matter."""
    ranged = in_ranges(rows, order, purpose)
    totals = ranged.groupBy(RANGE).agg(F.sum(value).alias("__total"))
    ahead = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col(RANGE).alias("__of"), F.coalesce(F.sum("__total").over(ahead), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("__inside", F.sum(value).over(inside))
    joined = summed.join(F.broadcast(before), F.col(RANGE) == F.col("__of"))  # one row per range
    return joined.select(*rows.columns, (F.col("__inside") + F.col("__before")).alias(out))


def running_max_before(rows: DataFrame, order: Sequence[Column], value: Column, out: str, purpose: str) -> DataFrame:
    """The greatest ``value`` of all rows before each one in ``order``; NULL for the first."""
    ranged = in_ranges(rows, order, purpose)
    totals = ranged.groupBy(RANGE).agg(F.max(value).alias("__total"))
    ahead = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col(RANGE).alias("__of"), F.max("__total").over(ahead).alias("__before"))
    inside = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    known = ranged.withColumn("__inside", F.max(value).over(inside))
    joined = known.join(F.broadcast(before), F.col(RANGE) == F.col("__of"))
    return joined.select(*rows.columns, F.greatest("__inside", "__before").alias(out))
