"""Landing folder to partitioned table with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from municare.sinks.tables import replace_partitions


def ingest_landing(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    partition: str = "competencia_arquivo",
    build: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Take in what arrived since the last call and stop.

    ``landing`` holds one folder per arrival period (``<partition>=<value>``). A micro-batch
    only tells which periods changed; each is then read whole from the landing folder and
    replaced whole, so a part that arrives later completes its period instead of wiping it,
    and a repeated batch changes nothing. No watermark: no row is ever too late.
    """

    def apply(changed: DataFrame, _batch: int) -> None:
        values = [r[0] for r in changed.select(partition).distinct().collect()]  # periods
        if not values:
            return
        session = changed.sparkSession
        whole = session.read.schema(schema).parquet(landing).filter(F.col(partition).isin(values))
        replace_partitions(build(whole), target, [{partition: v} for v in values])

    query = (
        spark.readStream.schema(schema)
        .parquet(landing)
        .select(partition)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


PART = "_part"


def ingest_landing_parts(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    partition: str = "competencia_arquivo",
    build: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Take in the files that arrived since the last call, and read nothing else.

    The table keeps the rows of every landed file as a part of their own (``partition``, ``_part`` = name of
    the file). A new file adds its parts to its periods; a file of a name that is known replaces what came
    under it, in any folder below ``landing``, so a batch that is repeated after a failure, or a whole landing
    folder read again under a new checkpoint, changes nothing. ``build`` keeps the columns ``partition`` and
    ``_part`` and the rows of ``schema``. Read the table with ``read_table``.
    """
    wide = T.StructType([*schema.fields, T.StructField(PART, T.StringType())])

    def apply(arrived: DataFrame, _batch: int) -> None:
        named = [r.asDict() for r in arrived.select(partition, PART).distinct().collect()]  # files
        if named:
            replace_partitions(arrived.select(*wide.names), target, named)

    arrived = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .parquet(landing)
        .select("*", F.col("_metadata.file_name").alias(PART))
    )
    query = (
        build(arrived)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
