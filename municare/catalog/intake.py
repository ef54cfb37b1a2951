"""Source normalisation, validation counts and declared checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municare import storage
from municare.catalog import landed
from municare.catalog.landed import code6
from municare.catalog.models import ADMISSION, BIRTH, DEATH
from municare.catalog.registry import query, table
from municare.intake import ingest_file, open_raw
from municare.operators import quality
from municare.operators.quality import Check
from municare.plans import Workspace
from municare.plans.staging import quarantine
from municare.sources import raw as src
from municare.sources.landing import records_from_text
from municare.sources.lookups import REFERENCE_CODES
from municare.schemas import not_null
from municare.session import narrow_scans, shared_folder
from municare.sources.validate import field_audit, value_audit

SCOPED = ", ".join(f"'{c}'" for c in REFERENCE_CODES)


@query(
    "src_facility_file",
    f"""
select distinct lpad(cast(o_custkey as varchar), 7, '0') as codigo_cnes,
    {code6("o_custkey % 27")} as cod_municipio_ibge6, strftime(o_orderdate, '%Y%m') as competencia
from orders where {code6("o_custkey % 27")} in ({SCOPED})""",
)
def facility_file(spark: SparkSession, folder: str) -> DataFrame:
    rows = src.normalize(landed.facility_file(spark, folder), "raw_cnes.estabelecimentos")
    return rows.select("codigo_cnes", "cod_municipio_ibge6", "competencia")


OTHERS = [c for i in range(27) if (c := str(100000 + i)) not in REFERENCE_CODES][5:7]


def _landing(spark: SparkSession, rows: DataFrame, *names: str) -> str:
    """A landing folder with the rows dealt over parts of these names. They are written once, by the usual
    tasks, so that a part is a folder of files."""
    landing, part = shared_folder(spark, "landing"), "__part"
    dealt = rows.withColumn(part, F.pmod(F.xxhash64(*rows.columns), F.lit(len(names))))
    with narrow_scans(spark):  # a task sorts its rows by part
        dealt.write.partitionBy(part).parquet(landing)
    for i, name in enumerate(names):
        if storage.exists(spark, f"{landing}/{part}={i}"):
            storage.rename(spark, f"{landing}/{part}={i}", f"{landing}/{name}")
        else:
            rows.limit(0).write.parquet(f"{landing}/{name}")
    return landing


@query(
    "q43_ingest_other_municipalities",
    f"""
select distinct lpad(cast(o_custkey as varchar), 7, '0') as codigo_cnes,
    {code6("o_custkey % 27")} as cod_municipio_ibge6, strftime(o_orderdate, '%Y%m') as competencia
from orders where {code6("o_custkey % 27")} in ({", ".join(f"'{c}'" for c in OTHERS)})""",
)
def ingest_other_municipalities(spark: SparkSession, folder: str) -> DataFrame:
    """Facilities landed in three parts, suffixes and letter case mixed, loaded for two
    municipalities other than the usual ones."""
    rows = landed.facility_file(spark, folder)
    landing = _landing(spark, rows, "STRJ2501.parquet", "strj2501A.parquet", "StRj2501b.PARQUET")
    root, name = shared_folder(spark, "lake"), "raw_cnes.estabelecimentos"
    for _ in range(2):
        ingest_file(spark, landing, root, name, "rj", 2025, 1, scope=OTHERS)
    return open_raw(spark, root)[name].select("codigo_cnes", "cod_municipio_ibge6", "competencia")


@query(
    "q44_ingest_parts_of_an_arrival",
    """
select '202501' as competencia_arquivo, strftime(l_shipdate, '%Y%m') as competencia, 3 as files,
    count(*) as n, cast(sum(cast(l_quantity as int)) as bigint) as q
from lineitem group by 2""",
)
def ingest_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Production landed in three parts; every part is found, tagged and read once, late
    periods included, and loading again replaces the arrival."""
    rows = landed.production_file(spark, folder)
    landing = _landing(spark, rows, "PARJ2501a.parquet", "parj2501B.parquet", "PARJ2501c.parquet")
    root, name = shared_folder(spark, "lake"), "raw_sia.producao_ambulatorial"
    for _ in range(2):
        ingest_file(spark, landing, root, name, "rj", 2025, 1)
    stored = open_raw(spark, root)[name]
    files = stored.agg(F.countDistinct("_source_file").cast("int").alias("files"))
    counted = stored.groupBy("competencia_arquivo", "competencia").agg(
        F.count("*").alias("n"), F.sum(F.col("quantidade_produzida").cast("int")).alias("q")
    )
    return counted.select("competencia_arquivo", "competencia", files.select("files").scalar().alias("files"), "n", "q")


@query(
    "q45_missing_values",
    """
select 'valor_total' as "column", count(*) as missing from orders where o_orderkey % 7 = 0
union all
select 'diagnostico_principal', count(*) from orders where o_custkey % 5 = 0""",
)
def missing_values(spark: SparkSession, folder: str) -> DataFrame:
    """Admission records damaged in two fields: which required columns lack how many values."""
    damaged = landed.admission_file(spark, folder)
    rows = src.normalize(damaged, "raw_sih.internacoes", {})
    number = F.col("numero_aih").cast("bigint")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    rows = rows.join(orders, number == F.col("o_orderkey"))
    rows = rows.withColumn("valor_total", F.when(F.col("o_orderkey") % 7 != 0, F.col("valor_total")))
    rows = rows.withColumn(
        "diagnostico_principal", F.when(F.col("o_custkey") % 5 != 0, F.col("diagnostico_principal"))
    )
    present = [c for c in not_null("raw_sih.internacoes") if c in rows.columns]
    return value_audit(rows, present)


@query(
    "src_team_file",
    f"""
select lpad(cast(c_custkey as varchar), 10, '0') as id_equipe,
    {code6("c_nationkey")} as cod_municipio_ibge6, c_mktsegment as descricao_segmento,
    case when c_acctbal < 0 then '202306' else '900001' end as competencia_desativacao
from customer where c_mktsegment <> 'BUILDING' and {code6("c_nationkey")} in ({SCOPED})""",
)
def team_file(spark: SparkSession, folder: str) -> DataFrame:
    rows = src.normalize(landed.team_file(spark, folder), "raw_cnes.equipes_aps")
    return rows.select(
        "id_equipe", "cod_municipio_ibge6", "descricao_segmento", "competencia_desativacao"
    )


@query(
    "src_admission_file",
    f"""
select numero_aih, strftime(competencia_date, '%Y%m') as competencia, diagnostico_principal,
    strftime(data_internacao, '%Y%m%d') as data_internacao
from (select {ADMISSION}, {code6("o_custkey % 27")} as place from orders)
where place in ({SCOPED})""",
)
def admission_file(spark: SparkSession, folder: str) -> DataFrame:
    rows = src.normalize(landed.admission_file(spark, folder), "raw_sih.internacoes")
    return rows.select("numero_aih", "competencia", "diagnostico_principal", "data_internacao")


@query(
    "src_death_file",
    f"""
select codigo_cnes_estabelecimento, strftime(data_obito, '%d%m%Y') as data_obito, causa_basica
from (select {DEATH}, {code6("user_id % 27")} as place from events) where place in ({SCOPED})""",
)
def death_file(spark: SparkSession, folder: str) -> DataFrame:
    rows = src.normalize(landed.death_file(spark, folder), "raw_sim.obitos")
    return rows.select("codigo_cnes_estabelecimento", "data_obito", "causa_basica")


@query(
    "src_birth_file",
    f"""
select codigo_cnes_estabelecimento, strftime(data_nascimento, '%d%m%Y') as data_nascimento,
    coalesce(cast(apgar1 as varchar), '') as apgar1
from (select {BIRTH}, {code6("p_size % 27")} as place from part) where place in ({SCOPED})""",
)
def birth_file(spark: SparkSession, folder: str) -> DataFrame:
    rows = src.normalize(landed.birth_file(spark, folder), "raw_sinasc.nascidos_vivos")
    return rows.select("codigo_cnes_estabelecimento", "data_nascimento", "apgar1")


@query(
    "src_production_file",
    """
select lpad(cast(l_suppkey as varchar), 7, '0') as codigo_cnes_estabelecimento,
    strftime(l_shipdate, '%Y%m') as competencia, count(*) as n,
    cast(sum(cast(l_quantity as int)) as bigint) as q
from lineitem group by 1, 2""",
)
def production_file(spark: SparkSession, folder: str) -> DataFrame:
    rows = src.normalize(landed.production_file(spark, folder), "raw_sia.producao_ambulatorial")
    return rows.groupBy("codigo_cnes_estabelecimento", "competencia").agg(
        F.count("*").alias("n"), F.sum(F.col("quantidade_produzida").cast("int")).alias("q")
    )


@query(
    "q30_hierarchy_flatten",
    """
select cast(c_custkey as int) as id_municipio, c_name as nome_municipio,
    case when c_acctbal >= 0 then n_nationkey end as id_microrregiao,
    case when c_acctbal >= 0 then n_name end as nome_microrregiao,
    case when c_acctbal >= 0 then n_nationkey end as id_mesorregiao,
    case when c_acctbal >= 0 then n_name end as nome_mesorregiao,
    n_nationkey as id_uf, left(n_name, 3) as sigla_uf, n_name as nome_uf,
    r_regionkey as id_regiao, left(r_name, 2) as sigla_regiao, r_name as nome_regiao
from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey""",
)
def hierarchy_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as places of a five-level hierarchy; debtors lack the lower levels."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey")
    )
    places = table(spark, folder, "customer").join(nations, F.expr("c_nationkey = n_nationkey"))
    state = """named_struct('id', n_nationkey, 'sigla', left(n_name, 3), 'nome', n_name,
        'regiao', named_struct('id', r_regionkey, 'sigla', left(r_name, 2), 'nome', r_name))"""
    document = F.expr(f"""
        named_struct('id', c_custkey, 'nome', c_name,
            'microrregiao', if(c_acctbal >= 0, named_struct('id', n_nationkey, 'nome', n_name,
                'mesorregiao', named_struct('id', n_nationkey, 'nome', n_name, 'UF', {state})), null),
            'regiao-imediata', named_struct('id', 1, 'nome', 'x',
                'regiao-intermediaria', named_struct('id', 1, 'nome', 'x', 'UF', {state})))
    """)
    return src.territory(records_from_text(landed._documents(places, document)))


@query(
    "q31_array_map_explode",
    """
select cast(o_orderkey as int) as id_municipio, 'ORDER ' || o_orderkey as nome_municipio,
    cast(year(o_orderdate) as int) as ano_referencia, cast(floor(o_totalprice) as bigint) as populacao_estimada
from orders
union all
select cast(o_custkey as int), 'CUSTOMER ' || o_custkey, cast(month(o_orderdate) as int), 7
from orders""",
)
def array_map_explode(spark: SparkSession, folder: str) -> DataFrame:
    """One document per order holding two places, each with a year-to-number map."""
    document = F.expr("""
        array(named_struct('id', '1', 'resultados', array(named_struct('series', array(
            named_struct('localidade', named_struct('id', cast(o_orderkey as string),
                    'nome', concat('ORDER ', o_orderkey)),
                'serie', map(cast(year(o_orderdate) as string),
                    cast(cast(floor(o_totalprice) as bigint) as string))),
            named_struct('localidade', named_struct('id', cast(o_custkey as string),
                    'nome', concat('CUSTOMER ', o_custkey)),
                'serie', map(cast(month(o_orderdate) as string), '7')))))))
    """)
    return src.population(landed._documents(table(spark, folder, "orders"), document))


@query(
    "q32_required_field_audit",
    """
select 'k' as field, 0::bigint as missing union all
select 'value', count(*) from events where event_type = 'view' union all
select 'note', 0 union all
select 'absent', count(*) from events""",
)
def required_field_audit(spark: SparkSession, folder: str) -> DataFrame:
    """A key left out counts as missing, a key holding null does not."""
    records = table(spark, folder, "events").select(
        F.expr("""if(event_type = 'view', concat('{"k": 1, "note": null}'),
            concat('{"k": 1, "note": null, "value": ', cast(value as string), '}'))""").alias("value"),
        F.lit("events.json").alias("_source_file"),
    )
    audited = field_audit(records_from_text(records), ["k", "value", "note", "absent"])
    return audited.select("field", "missing")


@query(
    "q33_count_by_area",
    f"""
select {code6("s_nationkey")} as cod_municipio_ibge6, 'all' as competencia,
    cast(count(*) as int) as quantidade_estabelecimentos
from supplier group by 1""",
)
def count_by_area(spark: SparkSession, folder: str) -> DataFrame:
    return src.facility_counts(
        table(spark, folder, "supplier").selectExpr(
            f"{code6('s_nationkey')} as CODUFMUN", "'all' as COMPETEN"
        )
    )


@query(
    "q35_tolerant_quarantine",
    """
select 'competencia' as "column", count(*) filter (where l_linenumber = 7) as unreadable from lineitem
union all select 'idade_paciente', count(*) filter (where l_quantity < 3) from lineitem
union all select 'quantidade_produzida', 0 from lineitem where false
union all select 'quantidade_produzida', 0
union all select 'quantidade_aprovada', 0
union all select 'valor_produzido', count(*) filter (where l_returnflag = 'R') from lineitem
union all select 'valor_aprovado', 0""",
)
def tolerant_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged months, ages and amounts are counted instead of stopping the load."""
    rows = (
        table(spark, folder, "lineitem")
        .selectExpr(
            "if(l_linenumber = 7, '199913', date_format(l_shipdate, 'yyyyMM')) as competencia",
            "if(l_quantity < 3, '?', cast(cast(l_quantity as int) as string)) as idade_paciente",
            "cast(l_linenumber as string) as quantidade_produzida",
            "cast(l_linenumber as string) as quantidade_aprovada",
            "if(l_returnflag = 'R', '1,50', '1.50') as valor_produzido",
            "'0.00' as valor_aprovado",
        )
    )
    return quarantine(rows, "raw_sia.producao_ambulatorial")


def _check_row(model: str, column: str, test: str, severity: str, failures: str) -> str:
    return (
        f"select '{model}' as model, '{column}' as \"column\", '{test}' as test,"
        f" '{severity}' as severity, cast(({failures}) as bigint) as failures"
    )


@query(
    "q27_dq_unique_not_null",
    " union all ".join(
        (
            _check_row("lineitem", "l_orderkey", "unique", "error",
                       "select count(*) from (select l_orderkey from lineitem group by 1 having count(*) > 1)"),
            _check_row("lineitem", "l_suppkey", "not_null", "error",
                       "select count(*) from lineitem where l_suppkey is null"),
            _check_row("orders", "o_orderkey", "unique", "error",
                       "select count(*) from (select o_orderkey from orders group by 1 having count(*) > 1)"),
            _check_row("orders", "late_key", "not_null", "warn",
                       "select count(*) from orders where o_orderstatus = 'F'"),
        )
    ),
)
def dq_unique_not_null(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn(
        "late_key", F.expr("if(o_orderstatus = 'F', null, o_orderkey)")
    )
    return quality.run(
        [
            Check("lineitem", "l_orderkey", "unique"),
            Check("lineitem", "l_suppkey", "not_null"),
            Check("orders", "o_orderkey", "unique"),
            Check("orders", "late_key", "not_null", severity="warn"),
        ],
        {"lineitem": table(spark, folder, "lineitem"), "orders": orders},
    )


@query(
    "q28_dq_accepted_values",
    " union all ".join(
        (
            _check_row("orders", "o_orderstatus", "accepted_values", "warn",
                       "select count(*) from orders where o_orderstatus not in ('F', 'O')"),
            _check_row("events", "kind", "accepted_values", "error",
                       "select count(*) from events where event_type = 'error'"),
        )
    ),
)
def dq_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    """NULL passes."""
    events = table(spark, folder, "events").withColumn("kind", F.expr("nullif(event_type, 'signup')"))
    return quality.run(
        [
            Check("orders", "o_orderstatus", "accepted_values", ("F", "O"), severity="warn"),
            Check("events", "kind", "accepted_values", ("view", "click", "purchase")),
        ],
        {"orders": table(spark, folder, "orders"), "events": events},
    )


@query(
    "q29_dq_relationships",
    " union all ".join(
        (
            _check_row("orders", "o_custkey", "relationships", "warn",
                       "select count(*) from orders where o_custkey not in"
                       " (select c_custkey from customer where c_acctbal >= 0)"),
            _check_row("lineitem", "l_suppkey", "relationships", "error",
                       "select count(*) from lineitem where l_suppkey not in"
                       " (select s_suppkey from supplier)"),
        )
    ),
)
def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "customer").filter("c_acctbal >= 0")
    return quality.run(
        [
            Check("orders", "o_custkey", "relationships",
                  parent="customer", parent_column="c_custkey", severity="warn"),
            Check("lineitem", "l_suppkey", "relationships",
                  parent="supplier", parent_column="s_suppkey"),
        ],
        {
            "orders": table(spark, folder, "orders"),
            "lineitem": table(spark, folder, "lineitem"),
            "customer": known,
            "supplier": table(spark, folder, "supplier"),
        },
    )


FACT_CHECKS = [
    Check("fct_producao_ambulatorial", "competencia_arquivo", "not_null"),
    Check("fct_producao_ambulatorial", "id_municipio_estabelecimento", "not_null"),
    Check("fct_producao_ambulatorial", "codigo_cnes_estabelecimento", "relationships",
          parent="dim_estabelecimento", parent_column="codigo_cnes", severity="warn"),
    Check("int_sih__diagnostico_icsap", "diagnostico_principal", "unique"),
    Check("mart_alertas_saude", "id_alerta", "unique"),
    Check("mart_historico_rede_cnes", "situacao_operacional", "accepted_values",
          ("ativo", "historico")),
]


@query(
    "q36_dq_models",
    " union all ".join(
        (
            _check_row("fct_producao_ambulatorial", "competencia_arquivo", "not_null", "error", "select 0"),
            _check_row("fct_producao_ambulatorial", "id_municipio_estabelecimento", "not_null", "error",
                       "select count(*) from lineitem where l_suppkey % 27 >= 25"),
            _check_row("fct_producao_ambulatorial", "codigo_cnes_estabelecimento", "relationships", "warn",
                       "select count(*) from lineitem where l_suppkey not in (select o_custkey from orders)"),
            _check_row("int_sih__diagnostico_icsap", "diagnostico_principal", "unique", "error", "select 0"),
            _check_row("mart_alertas_saude", "id_alerta", "unique", "error", "select 0"),
            _check_row("mart_historico_rede_cnes", "situacao_operacional", "accepted_values", "error",
                       "select count(*) from (select o_custkey, max(date_trunc('month', o_orderdate)) as d"
                       " from orders group by 1)"
                       " where d < (select date_trunc('month', max(o_orderdate)) from orders)"),
        )
    ),
)
def dq_models(spark: SparkSession, folder: str) -> DataFrame:
    """Declared checks over built models, row-level checks of a model sharing one pass."""
    space = Workspace(spark, landed.raw_tables(spark, folder))
    names = {c.model for c in FACT_CHECKS} | {c.parent for c in FACT_CHECKS if c.parent}
    return quality.run(FACT_CHECKS, {name: space[name] for name in sorted(names)})
