"""Upsert, partition replacement, incremental refresh and streamed ingest, written to the
shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municare import storage
from municare.catalog.registry import comparable, query, table
from municare.operators import keep_other_partitions, latest_per_key, upsert_rows
from municare.session import shared_folder
from municare.sinks import (
    read_table,
    read_upserted,
    refresh_incremental,
    replace_partitions,
    upsert,
)
from municare.sources import read_parts
from municare.sources.landing import POSITION
from municare.streaming import ingest_landing

MONEY = "decimal(18,2)"
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_quantity", "l_partkey", "l_suppkey",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LAST_LINE = f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus, l_extendedprice,
    cast(l_shipdate as date) as l_shipdate
from (select *, row_number() over (partition by l_orderkey, l_linenumber
    order by l_linestatus desc, {", ".join(c + " desc" for c in LINE_ORDER)}) as r from lineitem)
where r = 1"""


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select(
        *LINE_KEYS, "l_partkey", "l_suppkey", "l_linestatus", "l_extendedprice",
        F.col("l_shipdate").cast("date"),
    )


@query("q23_upsert_last_wins", LAST_LINE)
def upsert_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    """Finished lines are stored first; open lines of the same key replace them."""
    lines = table(spark, folder, "lineitem")
    stored, batch = (lines.filter(F.col("l_linestatus") == s) for s in ("F", "O"))
    stored = latest_per_key(stored, LINE_KEYS, LINE_ORDER)
    return _shown(upsert_rows(stored, batch, LINE_KEYS, LINE_ORDER))


@query("q23_upsert_stored", LAST_LINE)
def upsert_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same through the sink: two batches, the second one twice."""
    lines = table(spark, folder, "lineitem")
    path = shared_folder(spark, "upsert")
    for status in ("F", "O", "O"):
        upsert(lines.filter(F.col("l_linestatus") == status), path, LINE_KEYS, LINE_ORDER, slots=8)
    return _shown(read_upserted(spark, path, lines.schema))


TWICE = """
select l_orderkey, l_linenumber, cast(max(l_quantity) + 1 as bigint) as q, 'second' as told
from lineitem group by 1, 2"""


@query("q40_upsert_later_record_wins", TWICE)
def later_record_wins(spark: SparkSession, folder: str) -> DataFrame:
    """Every line comes twice in one landed file, under one load time and one file name; the
    later record of the file wins. The second load does the same again."""
    lines = table(spark, folder, "lineitem").groupBy(*LINE_KEYS).agg(
        F.max("l_quantity").cast("bigint").alias("q")
    )
    twice = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("told")) for i, t in enumerate(("first", "second"))]))
    records = lines.select("*", twice.alias("at")).select(*LINE_KEYS, (F.col("q") + F.col("at.i")).alias("q"), "at.told")
    landing, path = shared_folder(spark, "twice"), shared_folder(spark, "upsert")
    # A line's records follow each other in the task that made them; an even number of them fills a file.
    records.write.option("maxRecordsPerFile", 1_000_000).parquet(landing)
    parts = [f"{landing}/{n}" for n in storage.names(spark, landing) if n.endswith(".parquet")]
    for _ in range(2):
        landed = read_parts(spark, parts).withColumn("_loaded_at", F.lit("2025-01-01").cast("timestamp"))
        upsert(landed, path, LINE_KEYS, slots=8, order_only=(POSITION,))
    stored = landed.drop(POSITION).schema
    return read_upserted(spark, path, stored).select(*LINE_KEYS, "q", "told")


@query("q41_upsert_with_other_slots", LAST_LINE)
def upsert_with_other_slots(spark: SparkSession, folder: str) -> DataFrame:
    """A table filled with 8 slots, then loaded with 16 and with as many as it has: each key once."""
    lines = table(spark, folder, "lineitem")
    path = shared_folder(spark, "slots")
    for status, slots in (("F", 8), ("O", 16), ("O", None)):
        upsert(lines.filter(F.col("l_linestatus") == status), path, LINE_KEYS, LINE_ORDER, slots=slots)
    return _shown(read_upserted(spark, path, lines.schema))


REPLACED = """
with changed as (
    select strftime(o_orderdate, '%Y%m') as m, cast(o_totalprice as decimal(18,2))
        + case when strftime(o_orderdate, '%Y%m') = '199706' then 1 else 0 end as v from orders)
select m, count(*) as n, cast(sum(v) as double) as total from changed where m <> '199801' group by m"""


def _orders_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast(MONEY).alias("v"),
        F.date_format("o_orderdate", "yyyyMM").alias("m"),
    )


def _periods(rows: DataFrame, column: str) -> list[str]:
    """The periods a caller names when it loads everything: one value per month."""
    return sorted(r[0] for r in rows.select(column).distinct().collect())


@query("q24_partition_replace", REPLACED)
def partition_replace(spark: SparkSession, folder: str) -> DataFrame:
    """A month reloaded with new values and a month reloaded with an empty batch."""
    rows = _orders_by_month(spark, folder)
    path = shared_folder(spark, "replace")
    replace_partitions(rows, path, [{"m": p} for p in _periods(rows, "m")])
    june = rows.filter("m = '199706'").withColumn("v", (F.col("v") + 1).cast(MONEY))
    replace_partitions(june, path, [{"m": "199706"}])
    replace_partitions(rows.filter("false"), path, [{"m": "199801"}])
    stored = read_table(spark, path, rows.schema)
    return comparable(stored.groupBy("m").agg(F.count("*").alias("n"), F.sum("v").alias("total")))


@query("q24_partition_replace_relation", REPLACED)
def partition_replace_relation(spark: SparkSession, folder: str) -> DataFrame:
    rows = _orders_by_month(spark, folder)
    june = rows.filter("m = '199706'").withColumn("v", (F.col("v") + 1).cast(MONEY))
    kept = keep_other_partitions(rows, june, F.col("m").isin("199706", "199801"))
    return comparable(kept.groupBy("m").agg(F.count("*").alias("n"), F.sum("v").alias("total")))


def _arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with the month they happened in and the month they arrived in, up to two later."""
    return table(spark, folder, "lineitem").select(
        F.date_format("l_shipdate", "yyyyMM").alias("event"),
        F.date_format(F.add_months("l_shipdate", F.col("l_linenumber") % 3), "yyyyMM").alias("arrival"),
        F.col("l_quantity").cast("bigint").alias("q"),
        F.lit("2025-01-15 00:00:00").cast("timestamp").alias("_loaded_at"),
    )


ARRIVED = """(select strftime(l_shipdate, '%Y%m') as event,
    strftime(l_shipdate + to_months(cast(l_linenumber % 3 as int)), '%Y%m') as arrival,
    cast(l_quantity as bigint) as q from lineitem)"""


@query(
    "q25_incremental_arrival_vs_event",
    f"""
select event, count(*) as n,
    cast(sum(q + case when arrival = '199801' then 1 else 0 end) as bigint) as q,
    max(case when arrival = '199801' then date '2025-02-15' else date '2025-01-15' end) as newest
from {ARRIVED} group by event""",
)
def incremental(spark: SparkSession, folder: str) -> DataFrame:
    """One arrival period is loaded again with corrected quantities; only it is rebuilt, and
    the event months it reaches change."""
    first = _arrivals(spark, folder)
    path = shared_folder(spark, "incremental")
    refresh_incremental(first, path, lambda rows: rows, "arrival")
    corrected = first.filter("arrival = '199801'").select(
        "event", "arrival", (F.col("q") + 1).alias("q"),
        F.lit("2025-02-15 00:00:00").cast("timestamp").alias("_loaded_at"),
    )
    second = keep_other_partitions(first, corrected, F.col("arrival") == "199801")
    rebuilt = refresh_incremental(second, path, lambda rows: rows, "arrival")
    if rebuilt != ["199801"]:
        raise AssertionError(f"rebuilt {rebuilt}")
    stored = read_table(spark, path, first.schema)
    return stored.groupBy("event").agg(
        F.count("*").alias("n"),
        F.sum("q").alias("q"),
        F.max(F.to_date("_loaded_at")).alias("newest"),
    )


@query(
    "q26_bootstrap_partition",
    f"select event, arrival, count(*) as n from {ARRIVED} where arrival = '199801' group by 1, 2",
)
def bootstrap(spark: SparkSession, folder: str) -> DataFrame:
    """The first fill takes one arrival period at a time."""
    rows = _arrivals(spark, folder)
    path = shared_folder(spark, "bootstrap")
    refresh_incremental(rows, path, lambda r: r, "arrival", only="199801")
    return read_table(spark, path, rows.schema).groupBy("event", "arrival").agg(F.count("*").alias("n"))


@query(
    "q42_bootstrap_of_an_absent_period",
    f"select event, arrival, count(*) as n from {ARRIVED} where arrival = '199801' group by 1, 2",
)
def bootstrap_absent(spark: SparkSession, folder: str) -> DataFrame:
    """A period that the source does not hold is asked for: what is stored stays."""
    rows = _arrivals(spark, folder)
    path = shared_folder(spark, "bootstrap")
    refresh_incremental(rows, path, lambda r: r, "arrival", only="199801")
    without = rows.filter("arrival != '199801'")
    for period in ("199801", "209901"):
        if refresh_incremental(without, path, lambda r: r, "arrival", only=period):
            raise AssertionError(f"{period} is not in the source")
    return read_table(spark, path, rows.schema).groupBy("event", "arrival").agg(F.count("*").alias("n"))


@query(
    "q34_stream_landing",
    """
select strftime(ts, '%Y%m%d') as arrival, event_type, count(*) as n,
    cast(sum(cast(value as decimal(18,2))) as double) as total from events group by 1, 2""",
)
def stream_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Two visits to a landing folder: the second finds a late part of every period."""
    rows = table(spark, folder, "events").select(
        "event_id", "event_type", F.col("value").cast(MONEY).alias("v"),
        F.date_format("ts", "yyyyMMdd").alias("arrival"),
    )
    landing, target, state = (
        shared_folder(spark, name) for name in ("landing", "ingested", "progress")
    )
    for late in (False, True):
        part = rows.filter((F.col("event_type") == "signup") == F.lit(late))
        part.write.mode("append").partitionBy("arrival").parquet(landing)
        ingest_landing(spark, landing, rows.schema, target, state, "arrival")
    stored = read_table(spark, target, rows.schema)
    return comparable(
        stored.groupBy("arrival", "event_type").agg(F.count("*").alias("n"), F.sum("v").alias("total"))
    )
