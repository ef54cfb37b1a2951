"""What several operators share: words of a text, stored intermediate tables, running sums."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from municare.session import shared_folder

T = TypeVar("T")
_ROWS_AT_ONCE = 512  # whole texts that a Python worker holds as objects


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """Write ``rows`` once under the shared folder and read them back.

    Cuts the lineage, so that a lost executor costs a read and not the work before it, and
    gives joins a plain table on both sides, which lets AQE split a hot key.
    """
    path = shared_folder(rows.sparkSession, purpose)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def is_empty(rows: DataFrame) -> bool:
    return not rows.take(1)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column. ``bytes.split()`` then cuts at exactly the white space
    of the contracts, 0x20 and 0x09 to 0x0D, and ``bytes.lower()`` lowers A-Z alone."""
    return column.cast(pa.large_binary()).to_pylist()


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are held as Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
            yield batch.slice(at, _ROWS_AT_ONCE)


def map_texts(
    rows: DataFrame,
    keep: list[str],
    text: str,
    each: Callable[[list[bytes | None]], dict[str, pa.Array]],
    schema: str,
) -> DataFrame:
    """``keep`` columns as they are, and columns that ``each`` makes of a batch of whole texts.

    ``schema`` names the new columns.
    """
    slim = rows.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    names = list(slim.columns[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = each(texts_of(batch.column(len(names))))
            columns = [batch.column(i) for i in range(len(names))] + list(made.values())
            yield pa.RecordBatch.from_arrays(columns, names=names + list(made))

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    return slim.mapInArrow(run, f"{kept}, {schema}" if kept else schema)


def per_worker(spark: SparkSession, make: Callable[[], T]) -> Callable[[], T]:
    """Gives tasks an object of their worker's own, made when a task first asks for it, so that what it
    remembers serves all later batches and tasks of the worker."""
    kept = spark.sparkContext.broadcast({})

    def get() -> T:
        held = kept.value
        if "it" not in held:
            held["it"] = make()
        return held["it"]

    return get


def count_words(texts: list[bytes | None]) -> pa.Array:
    return pa.array([len(t.split()) if t else 0 for t in texts], pa.int64())


def with_running_sum(
    rows: DataFrame, group: list[str], order: list[Column], value: str, out: str, purpose: str
) -> DataFrame:
    """Inclusive running sum of ``value`` within ``group`` along ``order``, for groups of any size.

    ``order`` has to be total up to rows that may change places. The rows are cut into ranges
    of (group, order), so a hot group is shared by many tasks. Within a range a window sums;
    what earlier ranges of the same group add is a table of one row per range and group.
    """
    columns = rows.columns
    ranged = rows.repartitionByRange(*[F.col(g) for g in group], *order)
    ranged = stored(ranged.withColumn("__range", F.spark_partition_id()), purpose)
    from pyspark.sql import Window

    totals = ranged.groupBy("__range", *group).agg(F.sum(value).alias("__total"))
    ahead = Window.partitionBy(*group).orderBy("__range") if group else Window.orderBy("__range")
    before = F.sum("__total").over(ahead.rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(
        F.col("__range").alias("__of"),
        *[F.col(g).alias(f"__of_{g}") for g in group],
        F.coalesce(before, F.lit(0)).alias("__before"),
    )
    inside = Window.partitionBy("__range", *group).orderBy(*order)
    summed = ranged.withColumn(
        "__inside", F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    same = [F.col("__range") == F.col("__of")]
    same += [F.col(g).eqNullSafe(F.col(f"__of_{g}")) for g in group]
    joined = summed.join(totals, same, "left")
    return joined.select(*columns, (F.col("__inside") + F.col("__before")).alias(out))
