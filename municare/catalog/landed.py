"""Health-shaped landed records made by Spark from the star-schema test tables.

Facts become register lines in the layouts the sources have (coded fields, yyyyMM periods,
JSON documents), so the same source, staging and mart code runs on them whole:

nation -> municipality, customer/orders -> facility months, teams, receipts,
lineitem -> ambulatory production, orders -> admissions and budget report,
events -> deaths and fund ledger, part -> births and indicators.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municare.catalog.registry import table
from municare.sources import raw as src
from municare.sources.landing import records_from_text

LOADED_AT = "2025-01-15 00:00:00"
KNOWN = {"0": 3304557, "1": 3303807, "2": 3303500}


def code6(k: str) -> str:
    """SQL: six-digit municipality code of number ``k``; 25 and above have no municipality."""
    cases = " ".join(f"when {n} then '{str(i)[:6]}'" for n, i in KNOWN.items())
    return f"(case {k} {cases} else cast(100000 + {k} as string) end)"


def id7(k: str) -> str:
    """SQL: municipality id of number ``k``, NULL without a municipality."""
    cases = " ".join(f"when {k} = {n} then {i}" for n, i in KNOWN.items())
    return f"cast(case {cases} when {k} < 25 then 1000000 + {k} * 10 + {k} % 10 end as int)"


def pick(values: list[str], k: str) -> str:
    """SQL: the ``k``-th text of a short list."""
    cases = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"(case {k} {cases} end)"


def month_text(day: str) -> str:
    """SQL: yyyyMM text of a date."""
    return f"cast(year({day}) * 100 + month({day}) as string)"


TAX_IDS = ["42498733000148", "29172475000147", "29138278000101", "00000000000000"]
DOTTED_TAX_IDS = ["42.498.733/0001-48", "29.172.475/0001-47", "29.138.278/0001-01",
                  "00.000.000/0000-00"]
UNIT_TYPES = ["01", "05", "22", "36", "77", "85"]
LEGAL_NATURES = ["1015", "2062", "4000", "3999"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
TEAM_TYPES = ["70", "71", "73", "74", "76"]
TEAM_NAMES = ["eSF", "eSB", "eCR", "eAPP", "eAP"]


def by_segment(values: list[str]) -> str:
    cases = " ".join(f"when '{s}' then '{v}'" for s, v in zip(SEGMENTS, values))
    return f"(case c_mktsegment {cases} end)"


def _documents(rows: DataFrame, document) -> DataFrame:
    """(value, _source_file): one JSON document per row, nulls written."""
    options = {"ignoreNullFields": "false"}
    return rows.select(
        F.to_json(document, options).alias("value"), F.lit("landed.json").alias("_source_file")
    )


def _stamp(rows: DataFrame, year=None, month=None, url: bool = False) -> DataFrame:
    if url:
        rows = rows.drop("_source_file")
    at = F.lit(LOADED_AT).cast("timestamp")
    if url:
        return src.provenance(rows, "https://source.example", year, month, at, "_source_url")
    return src.provenance(rows, "landed.parquet", year, month, at)


def municipalities(spark: SparkSession, folder: str) -> DataFrame:
    """Every fifth place takes the path without a micro-region."""
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey")
    )
    state = """named_struct('id', r_regionkey + 11, 'sigla', left(r_name, 2), 'nome', r_name,
        'regiao', named_struct('id', r_regionkey + 1, 'sigla', left(r_name, 1), 'nome', r_name))"""
    document = F.expr(f"""
        named_struct(
            'id', {id7("n_nationkey")}, 'nome', n_name,
            'microrregiao', if(n_nationkey % 5 = 4, null, named_struct(
                'id', n_nationkey * 100, 'nome', concat('MICRO ', n_name),
                'mesorregiao', named_struct(
                    'id', n_nationkey * 10, 'nome', concat('MESO ', n_name), 'UF', {state}))),
            'regiao-imediata', named_struct(
                'id', n_nationkey, 'nome', n_name,
                'regiao-intermediaria', named_struct('id', n_nationkey, 'nome', n_name, 'UF', {state})))
    """)
    return _stamp(src.territory(records_from_text(_documents(places, document))), url=True)


def population(spark: SparkSession, folder: str) -> DataFrame:
    counts = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    document = F.expr(f"""
        array(named_struct('id', '9324', 'resultados', array(named_struct('series', array(
            named_struct(
                'localidade', named_struct(
                    'id', cast({id7("c_nationkey")} as string),
                    'nome', concat('NATION_', c_nationkey)),
                'serie', map('2025', cast(n * 1000 + c_nationkey as string))))))))
    """)
    return _stamp(src.population(_documents(counts, document)), url=True)


def facility_file(spark: SparkSession, folder: str) -> DataFrame:
    """One line per customer and month with an order, in the facility layout."""
    months = table(spark, folder, "orders").select(
        "o_custkey", F.expr(month_text("o_orderdate")).alias("m")
    ).distinct()
    return months.selectExpr(
        "lpad(cast(o_custkey as string), 7, '0') as CNES",
        f"{code6('o_custkey % 27')} as CODUFMUN",
        f"{pick(['1', '3', '9'], 'o_custkey % 3')} as PF_PJ",
        "if(o_custkey % 4 = 0, '1', '3') as NIV_DEP",
        f"{pick(UNIT_TYPES, 'o_custkey % 6')} as TP_UNID",
        "if(o_custkey % 2 = 0, '', 'X') as NATUREZA",
        f"{pick(LEGAL_NATURES, 'o_custkey % 4')} as NAT_JUR",
        "lpad(cast(o_custkey % 7 as string), 2, '0') as ATIVIDAD",
        "cast(o_custkey % 3 as string) as VINC_SUS",
        "substr('MEDSX', cast(o_custkey % 5 as int) + 1, 1) as TPGESTAO",
        "'M' as ESFERA_A",
        "m as COMPETEN",
        "m as DT_ATUAL",
    )


def facilities(spark: SparkSession, folder: str, scope=None) -> DataFrame:
    rows = src.normalize(facility_file(spark, folder), "raw_cnes.estabelecimentos", scope or {})
    return _stamp(rows, 2025, 12)


def network_size(spark: SparkSession, folder: str) -> DataFrame:
    return _stamp(src.facility_counts(facility_file(spark, folder)))


def team_file(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "lpad(cast(c_custkey as string), 10, '0') as IDEQUIPE",
        "lpad(cast(c_custkey * 2 as string), 7, '0') as CNES",
        f"{code6('c_nationkey')} as CODUFMUN",
        f"{by_segment(TEAM_TYPES)} as TIPO_EQP",
        "c_name as NOME_EQP",
        "'202001' as DT_ATIVA",
        "if(c_acctbal < 0, '202306', '900001') as DT_DESAT",
        "'00' as MOTDESAT",
        "'0' as TP_DESAT",
        "'202512' as COMPETEN",
        "cast(c_nationkey as string) as ID_AREA",
        "concat('AREA ', c_nationkey) as NOMEAREA",
        "cast(c_custkey % 10 as string) as ID_SEGM",
        "c_mktsegment as DESCSEGM",
        "'1' as TIPOSEGM",
    )


def teams(spark: SparkSession, folder: str, scope=None) -> DataFrame:
    wanted = {"TIPO_EQP": src.PRIMARY_CARE_TEAM_TYPES} if scope is None else scope
    return _stamp(src.normalize(team_file(spark, folder), "raw_cnes.equipes_aps", wanted), 2025, 12)


def facility_details(spark: SparkSession, folder: str) -> DataFrame:
    """Customers without debt are in the live register; the others are unknown to it."""
    customers = table(spark, folder, "customer").filter("c_acctbal >= 0")
    document = F.expr("""
        named_struct(
            'codigo_cnes', c_custkey,
            'nome_fantasia', if(c_mktsegment = 'MACHINERY', null, c_name),
            'endereco_estabelecimento', concat('RUA ', c_nationkey),
            'bairro_estabelecimento', c_mktsegment,
            'codigo_tipo_unidade', 22,
            'latitude_estabelecimento_decimo_grau', '-22.50000000',
            'estabelecimento_faz_atendimento_ambulatorial_sus',
                case c_custkey % 3 when 0 then 'SIM' when 1 then 'NAO' else 'X' end,
            'descricao_esfera_administrativa', 'MUNICIPAL',
            'estabelecimento_possui_centro_cirurgico', c_custkey % 2,
            'estabelecimento_possui_atendimento_hospitalar', if(c_custkey % 5 = 0, null, 1))
    """)
    records = records_from_text(_documents(customers, document))
    return _stamp(src.normalize(records, "raw_cnes.estabelecimentos_detalhados"), url=True)


def production_file(spark: SparkSession, folder: str) -> DataFrame:
    """Production lines plus the arrival period; up to two months late."""
    return table(spark, folder, "lineitem").selectExpr(
        "lpad(cast(l_suppkey as string), 7, '0') as PA_CODUNI",
        f"{code6('l_suppkey % 27')} as PA_UFMUN",
        f"{code6('l_partkey % 27')} as PA_MUNPCN",
        f"{month_text('l_shipdate')} as PA_CMP",
        "concat(lpad(cast(l_partkey % 10 + 1 as string), 2, '0'),"
        " lpad(cast(l_partkey as string), 8, '0')) as PA_PROC_ID",
        "cast(223500 + l_linenumber as string) as PA_CBOCOD",
        "lpad(cast(l_linenumber % 3 + 1 as string), 2, '0') as PA_CATEND",
        "if(l_quantity = 50, '999', lpad(cast(cast(l_quantity as int) as string), 3, '0')) as PA_IDADE",
        "if(l_returnflag = 'N', 'F', 'M') as PA_SEXO",
        "l_linestatus as PA_RACACOR",
        "cast(cast(l_quantity as int) as string) as PA_QTDPRO",
        "cast(cast(l_quantity as int) - l_linenumber as string) as PA_QTDAPR",
        "cast(cast(l_extendedprice as decimal(18,2)) as string) as PA_VALPRO",
        "cast(cast(l_extendedprice as decimal(18,2)) - l_linenumber as string) as PA_VALAPR",
        "if(l_linestatus = 'O', 'I', 'C') as PA_DOCORIG",
        f"{month_text('add_months(l_shipdate, l_linenumber % 3)')} as competencia_arquivo",
    )


def production(spark: SparkSession, folder: str) -> DataFrame:
    landed = production_file(spark, folder)
    rows = src.normalize(landed.withColumnRenamed("competencia_arquivo", src.SOURCE_FILE),
                         "raw_sia.producao_ambulatorial")
    rows = rows.withColumnRenamed(src.SOURCE_FILE, "competencia_arquivo")
    return _stamp(rows, F.expr("int(left(competencia, 4))"), F.expr("int(substr(competencia, 5, 2))"))


def admission_file(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "cast(o_orderkey as string) as N_AIH",
        "lpad(cast(o_custkey as string), 7, '0') as CNES",
        f"{code6('o_custkey % 27')} as MUNIC_MOV",
        f"{code6('o_orderkey % 27')} as MUNIC_RES",
        "cast(year(o_orderdate) as string) as ANO_CMPT",
        "cast(month(o_orderdate) as string) as MES_CMPT",
        "concat('03', lpad(cast(o_custkey as string), 8, '0')) as PROC_REA",
        "'223505' as CBOR",
        "cast(o_orderkey % 90 as string) as IDADE",
        "cast(o_orderkey % 2 + 1 as string) as SEXO",
        "lpad(cast(o_orderkey % 5 as string), 2, '0') as RACA_COR",
        "left(concat(substr('ABEGIJKLNOP', cast(o_orderkey % 11 as int) + 1, 1),"
        " lpad(cast(o_orderkey * 7 % 1000 as string), 3, '0')),"
        " if(o_orderpriority = '5-LOW', 3, 4)) as DIAG_PRINC",
        "cast(cast(o_totalprice as decimal(18,2)) as string) as VAL_TOT",
        "date_format(date_sub(o_orderdate, cast(o_orderkey % 40 as int)), 'yyyyMMdd') as DT_INTER",
        "date_format(o_orderdate, 'yyyyMMdd') as DT_SAIDA",
        "cast(o_orderkey % 40 as string) as DIAS_PERM",
        "if(o_orderstatus = 'F', '1', '0') as MORTE",
    )


def admissions(spark: SparkSession, folder: str, scope=None) -> DataFrame:
    rows = src.normalize(admission_file(spark, folder), "raw_sih.internacoes", scope or {})
    return _stamp(rows, 2025, 12)


def death_file(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "'1' as ORIGEM",
        "lpad(cast(user_id as string), 7, '0') as CODESTAB",
        f"{code6('user_id % 27')} as CODMUNOCOR",
        f"{code6('event_id % 27')} as CODMUNRES",
        "date_format(ts, 'ddMMyyyy') as DTOBITO",
        "date_format(date_sub(ts, cast(event_id % 30000 as int)), 'ddMMyyyy') as DTNASC",
        "lpad(cast(event_id % 1000 as string), 3, '0') as IDADE",
        "cast(event_id % 2 + 1 as string) as SEXO",
        "cast(event_id % 5 as string) as RACACOR",
        "'3' as ESTCIV",
        "'2' as ESC",
        "'1' as LOCOCOR",
        "event_type as CAUSABAS",
        "'9' as CIRCOBITO",
        "'1' as ASSISTMED",
    )


def deaths(spark: SparkSession, folder: str, scope=None) -> DataFrame:
    rows = src.normalize(death_file(spark, folder), "raw_sim.obitos", scope or {})
    return _stamp(rows, 2024)


def birth_file(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "'1' as ORIGEM",
        "lpad(cast(p_partkey as string), 7, '0') as CODESTAB",
        f"{code6('p_size % 27')} as CODMUNNASC",
        f"{code6('p_partkey % 27')} as CODMUNRES",
        "date_format(date_add(date '2022-01-01', cast(p_partkey % 365 as int)), 'ddMMyyyy') as DTNASC",
        "cast(p_partkey % 2 + 1 as string) as SEXO",
        "'1' as RACACOR",
        "cast(cast(floor(p_retailprice) as int) as string) as PESO",
        "'5' as GESTACAO",
        "cast(p_size % 2 + 1 as string) as PARTO",
        "if(p_size % 10 = 0, '', cast(p_size % 10 as string)) as APGAR1",
        "if(p_size % 7 = 0, '', cast(p_size % 7 as string)) as APGAR5",
        "cast(p_size % 12 as string) as CONSULTAS",
        "cast(p_size + 12 as string) as IDADEMAE",
        "p_type as ESCMAE",
    )


def births(spark: SparkSession, folder: str, scope=None) -> DataFrame:
    rows = src.normalize(birth_file(spark, folder), "raw_sinasc.nascidos_vivos", scope or {})
    return _stamp(rows, 2022)


def fund_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases and errors are debits, sign-ups an operation the ledger does not know."""
    document = F.expr(f"""
        named_struct(
            'id_lancamento_gestao_financeira', event_id,
            'cnpj_ente_solicitante_gestao_financeira', {pick(TAX_IDS, "user_id % 4")},
            'nome_ente_solicitante_gestao_financeira', concat('ENTE ', user_id % 4),
            'tipo_operacao_gestao_financeira', case when event_type in ('error', 'purchase')
                then 'D' when event_type = 'signup' then 'X' else 'C' end,
            'descricao_tipo_operacao_gestao_financeira', event_type,
            'descricao_gestao_financeira', concat('MOV ', event_type),
            'data_lancamento_gestao_financeira', date_format(ts, 'yyyy-MM-dd'),
            'data_evento_lancamento_gestao_financeira', date_format(ts, 'yyyy-MM-dd'),
            'valor_lancamento_gestao_financeira', cast(value as decimal(18,2)),
            'nome_favorecido_gestao_financeira', if(event_type = 'view', null, props))
    """)
    records = records_from_text(_documents(table(spark, folder, "events"), document))
    return _stamp(src.normalize(records, "raw_fns.repasses"), 2024, url=True)


def receipts(spark: SparkSession, folder: str) -> DataFrame:
    document = F.expr(f"""
        named_struct(
            'anoMes', (2020 + c_custkey % 5) * 100 + c_custkey % 12 + 1,
            'codigoPessoa', {pick(DOTTED_TAX_IDS, "c_custkey % 4")},
            'nomePessoa', c_name, 'tipoPessoa', 'Municipal', 'municipioPessoa', 'X',
            'siglaUFPessoa', 'RJ', 'codigoUG', '250006', 'nomeUG', c_mktsegment,
            'codigoOrgao', '36000', 'nomeOrgao', 'MS', 'codigoOrgaoSuperior', '36000',
            'nomeOrgaoSuperior', 'Ministério da Saúde',
            'valor', cast(c_acctbal as decimal(18,2)) - 4500)
    """)
    records = records_from_text(_documents(table(spark, folder, "customer"), document))
    rows = src.normalize(records, "raw_portaltransparencia.recursos_recebidos_saude")
    return _stamp(rows, F.expr("int(competencia / 100)"), url=True)


def budget(spark: SparkSession, folder: str) -> DataFrame:
    """Share of finished orders by place and two-month period, against a minimum."""
    from municare.plans.marts import SPENDING_ACCOUNT, SPENDING_APPLIED, SPENDING_MINIMUM

    shares = (
        table(spark, folder, "orders")
        .selectExpr(
            "cast(o_custkey % 25 as int) as k",
            "year(o_orderdate) as y",
            "cast(floor((month(o_orderdate) + 1) / 2) as int) as b",
            "o_orderstatus",
        )
        .groupBy("k", "y", "b")
        .agg(F.expr("10000 * count_if(o_orderstatus = 'F') div count(*)").alias("applied"))
    )
    def item(column: str, code: str, account: str, amount: str) -> str:
        return f"""named_struct('exercicio', y, 'demonstrativo', 'RREO', 'periodo', b,
            'periodicidade', 'B', 'instituicao', concat('P ', k), 'cod_ibge', {id7("k")},
            'uf', 'RJ', 'populacao', k * 1000, 'anexo', 'RREO-Anexo 14', 'esfera', 'M',
            'rotulo', 'R', 'coluna', '{column}', 'cod_conta', '{code}', 'conta', '{account}',
            'valor', {amount})"""

    applied = "concat(applied div 100, '.', lpad(cast(applied % 100 as string), 2, '0'))"
    items = ", ".join(
        (
            item(SPENDING_APPLIED, "C1", SPENDING_ACCOUNT, applied),
            item(SPENDING_MINIMUM, "C2", SPENDING_ACCOUNT, "concat(30 + b % 3, '.00')"),
            item(SPENDING_APPLIED, "C3", "Outra conta", "'1.00'"),
        )
    )
    document = F.expr(f"named_struct('items', array({items}))")
    records = records_from_text(_documents(shares, document), "envelope", "items")
    return _stamp(src.normalize(records, "raw_siops.rreo_anexo14"), url=True)


def indicators(spark: SparkSession, folder: str) -> DataFrame:
    document = F.expr(f"""
        named_struct('sisab_indicador_desempenho', array(named_struct(
            'uf', 'RJ', 'municipio', p_name, 'codigo_municipio', int({code6("p_partkey % 25")}),
            'quadrimestre', concat('2024Q', p_partkey % 3 + 1), 'competencia', 202412,
            'codigo_tipo_indicador', (p_size % 8 + 1) * 10, 'visao_equipe', p_type,
            'numerador', p_partkey, 'denominador_utilizador', p_partkey + 10,
            'denominador_identificado', p_partkey + 5, 'denominador_estimado', p_partkey + 10,
            'percentual', p_size, 'percentual_quadrimestre', if(p_size = 13, null, p_size * 2),
            'cadastro', p_partkey, 'base_externa', 1, 'populacao', p_partkey * 100)))
    """)
    text = _documents(table(spark, folder, "part"), document)
    records = records_from_text(text, "envelope", "sisab_indicador_desempenho")
    return _stamp(src.normalize(records, "raw_sisab.indicador_desempenho"), url=True)


def enrolment(spark: SparkSession, folder: str) -> DataFrame:
    document = F.expr(f"""
        named_struct('sisab_cadastro_vinculado', array(named_struct(
            'competencia_referencia', if(c_custkey % 2 = 0, 202412, 202408),
            'sigla_unidade_federacao', 'RJ', 'codigo_municipio_ibge', int({code6("c_nationkey")}),
            'nome_municipio', concat('NATION_', c_nationkey),
            'estimativa_populacional_ibge', c_nationkey * 1000,
            'tipo_equipe', int({by_segment(TEAM_TYPES)}), 'sigla_equipe', {by_segment(TEAM_NAMES)},
            'situacao_equipe', {pick(["válidas", "homologadas", "todas"], "c_custkey % 3")},
            'pessoas_vinculadas_criterios_ponderacao', {pick(["Sim", "Não", "Outro", "Não"], "c_custkey % 4")},
            'pessoas_vinculadas_equipe_municipio', 1000 + c_custkey)))
    """)
    text = _documents(table(spark, folder, "customer"), document)
    records = records_from_text(text, "envelope", "sisab_cadastro_vinculado")
    return _stamp(src.normalize(records, "raw_sisab.cadastro_vinculado"), url=True)


MAKERS: dict[str, Callable[..., DataFrame]] = {
    "raw_ibge.municipios": municipalities,
    "raw_ibge.populacao_estimada": population,
    "raw_cnes.estabelecimentos": facilities,
    "raw_cnes.equipes_aps": teams,
    "raw_cnes.estabelecimentos_detalhados": facility_details,
    "raw_cnes.rede_porte_municipio": network_size,
    "raw_sia.producao_ambulatorial": production,
    "raw_sih.internacoes": admissions,
    "raw_sim.obitos": deaths,
    "raw_sinasc.nascidos_vivos": births,
    "raw_fns.repasses": fund_ledger,
    "raw_portaltransparencia.recursos_recebidos_saude": receipts,
    "raw_siops.rreo_anexo14": budget,
    "raw_sisab.indicador_desempenho": indicators,
    "raw_sisab.cadastro_vinculado": enrolment,
}


def raw_tables(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """The fifteen raw tables, each made when first read."""
    return {name: partial(make, spark, folder) for name, make in MAKERS.items()}
