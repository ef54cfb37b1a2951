"""Name -> query and name -> checking SQL, filled by the modules of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say the same, its oracle."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def comparable(rows: DataFrame) -> DataFrame:
    """Types both engines print alike: decimals as double, load time as a date."""
    columns = []
    for f in rows.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            column = column.cast("date")
        columns.append(column.alias(f.name))
    return rows.select(*columns)
