"""The whole run: build every mart into the shared folder, then run every declared check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municare.catalog.landed import raw_tables
from municare.catalog.models import ORACLE, seed_sql
from municare.catalog.registry import comparable, query, table
from municare.operators.quality import Check
from municare.plans import CHECKS, build_marts, run_checks
from municare.session import shared_folder
from municare.sinks import publish, read_table, refresh_incremental
from municare.sources.lookups import SEED_SCHEMAS

# The staging view that shows the checked columns of each raw table unchanged.
STAGED = {
    "raw_ibge.municipios": "stg_ibge__municipios",
    "raw_ibge.populacao_estimada": "stg_ibge__populacao_estimada",
    "raw_cnes.estabelecimentos": "stg_cnes__estabelecimentos",
    "raw_cnes.equipes_aps": "stg_cnes__equipes_aps",
    "raw_cnes.estabelecimentos_detalhados": "stg_cnes__estabelecimentos_detalhados",
    "raw_cnes.rede_porte_municipio": "stg_cnes__rede_porte_municipio",
    "raw_fns.repasses": "stg_fns__repasses",
    "raw_portaltransparencia.recursos_recebidos_saude": "stg_portaltransparencia__recursos_recebidos",
    "raw_sia.producao_ambulatorial": "stg_sia__producao_ambulatorial",
    "raw_sih.internacoes": "stg_sih__internacoes",
}


def _failures(check: Check) -> str:
    relation = f'"{STAGED.get(check.model, check.model)}"'
    present = f"{check.column} is not null"
    if check.test == "not_null":
        return f"select count(*) from {relation} where {check.column} is null"
    if check.test == "accepted_values":
        listed = ", ".join(f"'{v}'" for v in check.values)
        return f"select count(*) from {relation} where {present} and {check.column} not in ({listed})"
    if check.test == "unique":
        return (
            f"select count(*) from (select {check.column} from {relation} where {present}"
            f" group by 1 having count(*) > 1)"
        )
    return (
        f"select count(*) from {relation} where {present} and {check.column} not in"
        f' (select {check.parent_column} from "{check.parent}" where {check.parent_column} is not null)'
    )


def _suite_sql() -> str:
    relations = {name: f"select * from {seed_sql(name)}" for name in SEED_SCHEMAS} | ORACLE
    with_ = ", ".join(f'"{name}" as materialized ({sql})' for name, sql in relations.items())
    rows = " union all ".join(
        f"select '{c.model}' as model, '{c.column}' as \"column\", '{c.test}' as test,"
        f" '{c.severity}' as severity, cast(({_failures(c)}) as bigint) as failures"
        for c in CHECKS
    )
    return f"with {with_} {rows}"


@query("q37_build_and_check", _suite_sql())
def build_and_check(spark: SparkSession, folder: str) -> DataFrame:
    return run_checks(build_marts(spark, raw_tables(spark, folder), shared_folder(spark, "marts")))


@query(
    "q38_full_refresh",
    """
select o_custkey, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
from orders group by 1""",
)
def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """A table rebuilt from scratch over an older version of itself."""
    orders = table(spark, folder, "orders")
    path = shared_folder(spark, "refresh")
    publish(orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")), path)
    totals = orders.groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")
    )
    return comparable(publish(totals, path))


@query(
    "q39_schema_sync",
    """
select strftime(o_orderdate, '%Y') as y, count(*) as n,
    cast(sum(case when year(o_orderdate) = 1998 then length(o_orderpriority) end) as bigint) as added
from orders group by 1""",
)
def schema_sync(spark: SparkSession, folder: str) -> DataFrame:
    """A column is added and another dropped; years not rebuilt yet show NULL."""
    rows = table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyy").alias("y"),
        "o_orderkey",
        "o_orderpriority",
        F.lit("2025-01-15 00:00:00").cast("timestamp").alias("_loaded_at"),
    )
    path = shared_folder(spark, "sync")
    refresh_incremental(rows, path, lambda r: r, "y")
    later = rows.withColumn(
        "_loaded_at", F.expr("if(y = '1998', timestamp '2025-02-15 00:00:00', _loaded_at)")
    )

    def build(r: DataFrame) -> DataFrame:
        return r.withColumn("added", F.length("o_orderpriority")).drop("o_orderpriority")

    refresh_incremental(later, path, build, "y")
    stored = read_table(spark, path, build(later).schema)
    return stored.groupBy("y").agg(F.count("*").alias("n"), F.sum("added").alias("added"))
