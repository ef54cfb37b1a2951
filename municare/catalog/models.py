"""Every model run on the landed records, checked by SQL written straight on the test tables.

The SQL never sees the coded registers: it states the expected result from the star schema,
so encoding, source normalisation, staging and mart are checked together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from municare.catalog.landed import (
    LEGAL_NATURES,
    TAX_IDS,
    TEAM_NAMES,
    UNIT_TYPES,
    by_segment,
    code6,
    id7,
    pick,
    raw_tables,
)
from municare.catalog.registry import comparable, query
from municare.plans import MODELS, Workspace
from municare.plans import marts as m
from municare.sources.lookups import SEED_SCHEMAS


def seed_sql(name: str) -> str:
    """SQL relation holding a shipped code table."""
    import csv
    from importlib import resources

    ddl = [c.strip().split(" ") for c in SEED_SCHEMAS[name].split(",")]
    text = resources.files("municare.seeds").joinpath(f"{name}.csv").read_text("utf-8")
    rows = list(csv.reader(text.splitlines()[2:]))

    def cell(value: str, kind: str) -> str:
        return value if kind == "int" else "'" + value.replace("'", "''") + "'"

    values = ", ".join(
        "(" + ", ".join(cell(v, kind) for v, (_, kind) in zip(row, ddl)) + ")" for row in rows
    )
    return f"(values {values}) as {name}({', '.join(c for c, _ in ddl)})"


def rounded(amount: str, base: str, scale: int, digits: int) -> str:
    """SQL: ``scale * amount / base`` rounded half up, in whole-number arithmetic."""
    up = scale * 10**digits
    return (
        f"cast((2 * {up} * cast({amount} as hugeint) + {base}) // (2 * {base}) as double)"
        f" / {10**digits}.0"
    )


URL = "date '2025-01-15' as _loaded_at, 'https://source.example' as _source_url"
FILE = "date '2025-01-15' as _loaded_at, 'landed.parquet' as _source_file"
FILE_2025 = f"{FILE}, 2025 as _reference_year, 12 as _reference_month"

TERRITORY = f"""
    {id7("n_nationkey")} as id_municipio, n_name as nome_municipio,
    case when n_nationkey % 5 <> 4 then cast(n_nationkey * 100 as int) end as id_microrregiao,
    case when n_nationkey % 5 <> 4 then 'MICRO ' || n_name end as nome_microrregiao,
    case when n_nationkey % 5 <> 4 then cast(n_nationkey * 10 as int) end as id_mesorregiao,
    case when n_nationkey % 5 <> 4 then 'MESO ' || n_name end as nome_mesorregiao,
    cast(r_regionkey + 11 as int) as id_uf, left(r_name, 2) as sigla_uf, r_name as nome_uf,
    cast(r_regionkey + 1 as int) as id_regiao, left(r_name, 1) as sigla_regiao,
    r_name as nome_regiao
"""
PLACES = "nation join region on n_regionkey = r_regionkey"
MONTHS = """(select distinct o_custkey as k, strftime(o_orderdate, '%Y%m') as p,
    cast(date_trunc('month', o_orderdate) as date) as d from orders)"""
POPULATION = f"""(select {id7("c_nationkey")} as id_municipio, {code6("c_nationkey")} as cod6,
    'NATION_' || c_nationkey as nome_municipio, 2025 as ano,
    cast(count(*) * 1000 + c_nationkey as bigint) as pop from customer group by c_nationkey)"""
NETWORK = f"""(select {code6("k % 27")} as cod6, p, cast(count(*) as int) as n
    from {MONTHS} group by 1, 2)"""

ORACLE: dict[str, str] = {}

ORACLE["stg_ibge__municipios"] = f"select {TERRITORY}, {URL} from {PLACES}"
ORACLE["dim_municipio"] = f"select {TERRITORY} from {PLACES}"
ORACLE["int_ibge__municipio_codigo6"] = f"""
select {id7("n_nationkey")} as id_municipio, {code6("n_nationkey")} as cod_municipio_ibge6,
    n_name as nome_municipio
from nation"""
ORACLE["stg_ibge__populacao_estimada"] = f"""
select id_municipio, nome_municipio, ano as ano_referencia, pop as populacao_estimada, {URL}
from {POPULATION}"""

FACILITY = f"""
    {pick(["fisica", "juridica"], "k % 3")} as tipo_pessoa,
    case when k % 4 = 0 then 'individual' else 'mantida' end as nivel_dependencia,
    {pick(UNIT_TYPES, "k % 6")} as codigo_tipo_unidade,
    {pick(["Posto de Saúde", "Hospital Geral", "Consultório Isolado",
           "Clínica Especializada/Ambulatório Especializado"], "k % 6")} as descricao_tipo_unidade,
    case when k % 2 = 1 then 'X' end as natureza_organizacao,
    {pick(LEGAL_NATURES, "k % 4")} as codigo_natureza_juridica,
    case k % 4 when 0 then 'Órgão Público do Poder Executivo Federal'
        when 1 then 'Sociedade Empresária Limitada'
        when 3 then 'Associação Privada' end as descricao_natureza_juridica,
    case k % 7 when 1 then 'unidade_universitaria' when 2 then 'unidade_escola_superior_isolada'
        when 3 then 'unidade_auxiliar_de_ensino' when 4 then 'sem_atividade_de_ensino'
        when 5 then 'hospital_de_ensino' else 'nao_informado' end as atividade_ensino,
    case when k % 3 < 2 then k % 3 = 1 end as tem_vinculo_sus,
    {pick(["municipal", "estadual", "dupla", "sem_gestao", "nao_informado"], "k % 5")} as tipo_gestao,
    'M' as esfera_administrativa
"""
CNES = "lpad(cast(k as varchar), 7, '0')"
ORACLE["stg_cnes__estabelecimentos"] = f"""
select {CNES} || '-' || p as id_estabelecimento_competencia, {CNES} as codigo_cnes,
    {code6("k % 27")} as cod_municipio_ibge6, {FACILITY}, p as competencia,
    d as competencia_date, p as data_atualizacao, {FILE_2025}
from {MONTHS}"""
DETAILS = """
    case when c_mktsegment <> 'MACHINERY' then c_name end as nome_fantasia,
    'RUA ' || c_nationkey as endereco, cast(null as varchar) as numero_endereco,
    c_mktsegment as bairro, cast(null as varchar) as codigo_cep,
    case when c_custkey is not null then -22.5::double end as latitude,
    cast(null as double) as longitude,
    case when c_custkey is not null then 'MUNICIPAL' end as descricao_esfera_administrativa,
    cast(null as varchar) as descricao_turno_atendimento, c_custkey % 2 = 1 as possui_centro_cirurgico,
    cast(null as boolean) as possui_centro_obstetrico,
    cast(null as boolean) as possui_centro_neonatal,
    case when c_custkey % 5 <> 0 then true end as possui_atendimento_hospitalar
"""
ORACLE["stg_cnes__estabelecimentos_detalhados"] = f"""
select lpad(cast(c_custkey as varchar), 7, '0') as codigo_cnes,
    cast(null as varchar) as nome_razao_social, '22' as codigo_tipo_unidade, {DETAILS},
    cast(null as varchar) as numero_telefone, cast(null as varchar) as email,
    case c_custkey % 3 when 0 then true when 1 then false end as faz_atendimento_ambulatorial_sus,
    cast(null as varchar) as codigo_motivo_desabilitacao,
    cast(null as boolean) as possui_servico_apoio,
    cast(null as boolean) as possui_atendimento_ambulatorial,
    cast(null as varchar) as data_atualizacao, {URL}
from customer where c_acctbal >= 0"""
ORACLE["dim_estabelecimento"] = f"""
with last as (select k, max(d) as d from {MONTHS} group by k)
select {CNES} as codigo_cnes, {id7("k % 27")} as id_municipio,
    {code6("k % 27")} as cod_municipio_ibge6, {FACILITY}, d as competencia_cadastro, {DETAILS}
from last left join customer on c_custkey = k and c_acctbal >= 0"""
ORACLE["mart_historico_rede_cnes"] = f"""
with spans as (select k, min(d) as first, max(d) as last from {MONTHS} group by k)
select {CNES} || '-' || p as id_estabelecimento_competencia, {CNES} as codigo_cnes,
    {id7("k % 27")} as id_municipio, d as competencia_cadastro,
    {pick(UNIT_TYPES, "k % 6")} as codigo_tipo_unidade,
    {pick(["Posto de Saúde", "Hospital Geral", "Consultório Isolado",
           "Clínica Especializada/Ambulatório Especializado"], "k % 6")} as descricao_tipo_unidade,
    {pick(["municipal", "estadual", "dupla", "sem_gestao", "nao_informado"], "k % 5")} as tipo_gestao,
    first as primeira_competencia_observada, last as ultima_competencia_observada,
    case when d < last then 'historico'
        when last = (select cast(date_trunc('month', max(o_orderdate)) as date) from orders)
        then 'ativo' else 'possivelmente_encerrado' end as situacao_operacional
from {MONTHS} join spans using (k)"""
ORACLE["stg_cnes__rede_porte_municipio"] = f"""
select cod6 as cod_municipio_ibge6, p as competencia, n as quantidade_estabelecimentos, {FILE}
from {NETWORK}"""

TEAM = f"""
    lpad(cast(c_custkey as varchar), 10, '0') as id_equipe,
    lpad(cast(c_custkey * 2 as varchar), 7, '0') as codigo_cnes,
    {by_segment(TEAM_NAMES)} as sigla_equipe, c_name as nome_equipe,
    case when c_acctbal < 0 then 'desativada' else 'ativa' end as situacao_equipe,
    '202512' as competencia, cast(c_nationkey as varchar) as id_area,
    'AREA ' || c_nationkey as nome_area, cast(c_custkey % 10 as varchar) as id_segmento,
    c_mktsegment as descricao_segmento, '1' as tipo_segmento
"""
ORACLE["stg_cnes__equipes_aps"] = f"""
select {TEAM}, {code6("c_nationkey")} as cod_municipio_ibge6,
    {by_segment(["70", "71", "73", "74", "76"])} as codigo_tipo_equipe,
    '202001' as competencia_ativacao,
    case when c_acctbal < 0 then '202306' else '900001' end as competencia_desativacao,
    '00' as motivo_desativacao, {FILE_2025}
from customer where c_mktsegment <> 'BUILDING'"""
ORACLE["mart_equipe_aps_detalhada"] = f"""
with known as (select distinct o_custkey as f from orders),
    register as (select c_custkey as r, c_name as rname, c_nationkey as rnation,
        c_mktsegment as rsegment from customer where c_acctbal >= 0)
select {TEAM},
    case when f is not null then {pick(["Posto de Saúde", "Hospital Geral", "Consultório Isolado",
        "Clínica Especializada/Ambulatório Especializado"], "(f % 6)")} end as descricao_tipo_unidade,
    case when rsegment <> 'MACHINERY' then rname end as nome_unidade,
    'RUA ' || rnation as endereco, rsegment as bairro,
    {id7("c_nationkey")} as id_municipio, 'NATION_' || c_nationkey as nome_municipio
from customer left join known on f = c_custkey * 2 left join register on r = f
where c_mktsegment <> 'BUILDING'"""

ORACLE["stg_sia__producao_ambulatorial"] = f"""
select lpad(cast(l_suppkey as varchar), 7, '0') as codigo_cnes_estabelecimento,
    {code6("l_suppkey % 27")} as cod_municipio_ibge6_estabelecimento,
    {code6("l_partkey % 27")} as cod_municipio_ibge6_paciente,
    strftime(l_shipdate, '%Y%m') as competencia,
    cast(date_trunc('month', l_shipdate) as date) as competencia_date,
    strftime(l_shipdate + to_months(cast(l_linenumber % 3 as int)), '%Y%m') as competencia_arquivo,
    lpad(cast(l_partkey % 10 + 1 as varchar), 2, '0')
        || lpad(cast(l_partkey as varchar), 8, '0') as codigo_procedimento,
    cast(223500 + l_linenumber as varchar) as codigo_cbo,
    '0' || (l_linenumber % 3 + 1) as carater_atendimento,
    cast(case when l_quantity <> 50 then l_quantity end as int) as idade_paciente,
    case when l_returnflag = 'N' then 'F' else 'M' end as sexo_paciente,
    l_linestatus as raca_cor_paciente, cast(l_quantity as int) as quantidade_produzida,
    cast(l_quantity - l_linenumber as int) as quantidade_aprovada,
    cast(cast(l_extendedprice as decimal(18,2)) as double) as valor_produzido,
    cast(cast(l_extendedprice as decimal(18,2)) - l_linenumber as double) as valor_aprovado,
    case when l_linestatus = 'O' then 'I' else 'C' end as origem_documento, {FILE},
    cast(year(l_shipdate) as int) as _reference_year,
    cast(month(l_shipdate) as int) as _reference_month
from lineitem"""
ORACLE["fct_producao_ambulatorial"] = f"""
select * exclude (competencia, _source_file, _reference_year, _reference_month,
        cod_municipio_ibge6_estabelecimento, cod_municipio_ibge6_paciente, sk, pk),
    {id7("(sk % 27)")} as id_municipio_estabelecimento, {id7("(pk % 27)")} as id_municipio_paciente
from ({ORACLE["stg_sia__producao_ambulatorial"].replace(
    "from lineitem", ", l_suppkey as sk, l_partkey as pk from lineitem")})"""
ORACLE["mart_producao_grupo_municipio"] = f"""
with totals as (
    select l_suppkey % 27 as s, cast(date_trunc('month', l_shipdate) as date) as d,
        lpad(cast(l_partkey % 10 + 1 as varchar), 2, '0') as g, count(*) as n,
        sum(cast(l_quantity as bigint)) as qp,
        sum(cast(l_quantity as bigint) - l_linenumber) as qa,
        sum(cast(l_extendedprice as decimal(18,2))) as vp,
        sum(cast(l_extendedprice as decimal(18,2)) - l_linenumber) as va
    from lineitem where l_suppkey % 27 < 25 group by 1, 2, 3)
select {id7("s")} as id_municipio, d as competencia_date, g as codigo_grupo, descricao_grupo,
    n as quantidade_registros, cast(qp as bigint) as quantidade_produzida,
    cast(qa as bigint) as quantidade_aprovada, cast(vp as double) as valor_produzido,
    cast(va as double) as valor_aprovado
from totals left join {seed_sql("seed_sigtap_grupo")} on codigo_grupo = g"""

DIAGNOSIS = """left(substr('ABEGIJKLNOP', cast(o_orderkey % 11 as int) + 1, 1)
    || lpad(cast(o_orderkey * 7 % 1000 as varchar), 3, '0'),
    case when o_orderpriority = '5-LOW' then 3 else 4 end)"""
ADMITTED = "cast(o_orderdate - to_days(cast(o_orderkey % 40 as int)) as date)"
ADMISSION = f"""
    cast(o_orderkey as varchar) as numero_aih,
    lpad(cast(o_custkey as varchar), 7, '0') as codigo_cnes_estabelecimento,
    cast(date_trunc('month', o_orderdate) as date) as competencia_date,
    '03' || lpad(cast(o_custkey as varchar), 8, '0') as codigo_procedimento,
    '223505' as codigo_cbo, cast(o_orderkey % 90 as varchar) as idade_paciente,
    cast(o_orderkey % 2 + 1 as varchar) as sexo_paciente, '0' || (o_orderkey % 5) as raca_cor_paciente,
    {DIAGNOSIS} as diagnostico_principal, cast(o_totalprice as double) as valor_total,
    {ADMITTED} as data_internacao, cast(o_orderdate as date) as data_saida,
    cast(o_orderkey % 40 as int) as dias_permanencia, o_orderstatus = 'F' as houve_obito
"""
ORACLE["stg_sih__internacoes"] = f"""
select {ADMISSION}, {code6("o_custkey % 27")} as cod_municipio_ibge6_estabelecimento,
    {code6("o_orderkey % 27")} as cod_municipio_ibge6_paciente,
    strftime(o_orderdate, '%Y%m') as competencia, {FILE_2025}
from orders"""
ORACLE["fct_internacoes"] = f"""
select {ADMISSION}, {id7("(o_custkey % 27)")} as id_municipio_estabelecimento,
    {id7("(o_orderkey % 27)")} as id_municipio_paciente
from orders"""
CLASSIFIED = f"""
    (select diagnosis, grupo_icsap, descricao_grupo
     from (select distinct {DIAGNOSIS} as diagnosis from orders)
     left join {seed_sql("seed_icsap_cid10")}
        on rpad(diagnosis, 4, '0') >= cid_inicio and rpad(diagnosis, 4, '0') <= cid_fim)"""
ORACLE["int_sih__diagnostico_icsap"] = f"""
select diagnosis as diagnostico_principal, grupo_icsap, descricao_grupo as descricao_grupo_icsap,
    grupo_icsap is not null as is_icsap
from {CLASSIFIED}"""
ORACLE["mart_icsap_municipio"] = f"""
with admitted as (
    select {id7("(o_orderkey % 27)")} as id_municipio, cast(year({ADMITTED}) as int) as ano,
        case when exists (select 1 from {seed_sql("seed_icsap_cid10")}
            where rpad({DIAGNOSIS}, 4, '0') between cid_inicio and cid_fim) then 1 else 0 end as hit
    from orders),
counted as (select id_municipio, ano, count(*) as n, cast(sum(hit) as bigint) as s
    from admitted where id_municipio is not null group by 1, 2)
select id_municipio, ano, n as total_internacoes, s as total_internacoes_icsap,
    {rounded("s", "n", 100, 1)} as percentual_icsap
from counted"""

DEATH = """
    lpad(cast(user_id as varchar), 7, '0') as codigo_cnes_estabelecimento,
    cast(ts as date) as data_obito,
    cast(cast(ts as date) - to_days(cast(event_id % 30000 as int)) as date) as data_nascimento,
    case when event_id % 1000 in (0, 999) then 'nao_informado'
        when event_id % 1000 < 100 then 'minutos' when event_id % 1000 < 200 then 'horas'
        when event_id % 1000 < 300 then 'dias' when event_id % 1000 < 400 then 'meses'
        when event_id % 1000 < 500 then 'anos' when event_id % 1000 < 600 then 'anos_mais_de_100'
        else 'nao_informado' end as idade_unidade,
    cast(case when event_id % 1000 not in (0, 999) then event_id % 100 end as int) as idade_valor,
    cast(event_id % 2 + 1 as varchar) as sexo, cast(event_id % 5 as varchar) as raca_cor,
    '3' as estado_civil, '2' as escolaridade, '1' as local_ocorrencia, event_type as causa_basica,
    '9' as circunstancia_obito, '1' as assistencia_medica, 2024 as _reference_year
"""
ORACLE["stg_sim__obitos"] = f"""
select {DEATH}, '1' as origem_informacao, {FILE},
    {code6("user_id % 27")} as cod_municipio_ibge6_ocorrencia,
    {code6("event_id % 27")} as cod_municipio_ibge6_residencia
from events"""
ORACLE["fct_obitos"] = f"""
select {DEATH}, {id7("(user_id % 27)")} as id_municipio_ocorrencia,
    {id7("(event_id % 27)")} as id_municipio_residencia
from events"""
BIRTH = """
    lpad(cast(p_partkey as varchar), 7, '0') as codigo_cnes_estabelecimento,
    cast(date '2022-01-01' + to_days(cast(p_partkey % 365 as int)) as date) as data_nascimento,
    cast(p_partkey % 2 + 1 as varchar) as sexo, '1' as raca_cor,
    cast(floor(p_retailprice) as int) as peso_gramas, '5' as semanas_gestacao_faixa,
    cast(p_size % 2 + 1 as varchar) as tipo_parto,
    cast(case when p_size % 10 > 0 then p_size % 10 end as int) as apgar1,
    cast(case when p_size % 7 > 0 then p_size % 7 end as int) as apgar5,
    cast(p_size % 12 as int) as numero_consultas_prenatal, cast(p_size + 12 as int) as idade_mae,
    p_type as escolaridade_mae, 2022 as _reference_year
"""
ORACLE["stg_sinasc__nascidos_vivos"] = f"""
select {BIRTH}, '1' as origem_informacao, {FILE},
    {code6("p_size % 27")} as cod_municipio_ibge6_nascimento,
    {code6("p_partkey % 27")} as cod_municipio_ibge6_residencia
from part"""
ORACLE["fct_nascidos_vivos"] = f"""
select {BIRTH}, {id7("(p_size % 27)")} as id_municipio_nascimento,
    {id7("(p_partkey % 27)")} as id_municipio_residencia
from part"""

OPERATION = """case when event_type in ('error', 'purchase') then 'debito'
    when event_type in ('view', 'click') then 'credito' end"""
AMOUNT = "cast(value as decimal(18,2))"
ENTITY = "cast(case {k} when 0 then 3304557 when 1 then 3303807 when 2 then 3303500 end as int)"
ORACLE["stg_fns__repasses"] = f"""
select event_id as id_lancamento, {pick(TAX_IDS, "user_id % 4")} as cnpj_ente_solicitante,
    'ENTE ' || (user_id % 4) as nome_ente_solicitante,
    cast(null as varchar) as codigo_programa_agil, {OPERATION} as tipo_operacao,
    event_type as descricao_tipo_operacao, 'MOV ' || event_type as descricao_lancamento,
    cast(ts as date) as data_lancamento, cast(ts as date) as data_evento_lancamento,
    cast(null as varchar) as numero_referencia_unica, cast(null as int) as tipo_favorecido,
    cast(null as varchar) as descricao_tipo_favorecido,
    case when event_type <> 'view' then props end as nome_favorecido,
    cast({AMOUNT} as double) as valor_lancamento, cast(null as int) as id_categoria_despesa,
    cast(null as int) as quantidade_subtransacoes, {URL}, 2024 as _reference_year
from events"""
ORACLE["mart_repasses_fns"] = f"""
select event_id as id_lancamento, {ENTITY.format(k="(user_id % 4)")} as id_municipio,
    {pick(TAX_IDS, "user_id % 4")} as cnpj_ente_solicitante,
    'ENTE ' || (user_id % 4) as nome_ente_solicitante, {OPERATION} as tipo_operacao,
    'MOV ' || event_type as descricao_lancamento, cast(ts as date) as data_lancamento,
    cast({AMOUNT} as double) as valor_lancamento, cast(year(ts) as int) as ano
from events"""
RECEIPT_MONTH = "(2020 + c_custkey % 5) * 100 + c_custkey % 12 + 1"
RECEIPT_DATE = "make_date(cast(2020 + c_custkey % 5 as int), cast(c_custkey % 12 + 1 as int), 1)"
RECEIPT = "cast(c_acctbal as decimal(18,2)) - 4500"
ORACLE["stg_portaltransparencia__recursos_recebidos"] = f"""
select cast({RECEIPT_MONTH} as int) as competencia, {RECEIPT_DATE} as competencia_date,
    {pick(TAX_IDS, "c_custkey % 4")} as cnpj_favorecido, c_name as nome_favorecido,
    'Municipal' as tipo_favorecido, 'X' as municipio_favorecido, 'RJ' as sigla_uf_favorecido,
    '250006' as codigo_ug, c_mktsegment as nome_ug, '36000' as codigo_orgao, 'MS' as nome_orgao,
    '36000' as codigo_orgao_superior, 'Ministério da Saúde' as nome_orgao_superior,
    cast({RECEIPT} as double) as valor, {URL},
    cast(2020 + c_custkey % 5 as int) as _reference_year
from customer"""
FUNDING = f"""
select 'fns_fundo_a_fundo' as fonte, {ENTITY.format(k="(user_id % 4)")} as id_municipio,
    cast(ts as date) as data_referencia, cast(year(ts) as int) as ano,
    {OPERATION} as tipo_lancamento, 'MOV ' || event_type as descricao_origem,
    case when event_type in ('error', 'purchase') then -{AMOUNT} else {AMOUNT} end as valor
from events
union all
select 'portal_transparencia', {ENTITY.format(k="(c_custkey % 4)")}, {RECEIPT_DATE},
    cast(2020 + c_custkey % 5 as int),
    case when c_acctbal >= 4500 then 'recurso' else 'estorno' end,
    'Ministério da Saúde - ' || c_mktsegment, {RECEIPT}
from customer"""
ORACLE["mart_financiamento_saude_uniao"] = f"""
select * replace (cast(valor as double) as valor) from ({FUNDING})"""

SHARES = """(select cast(o_custkey % 25 as int) as k, cast(year(o_orderdate) as int) as y,
    cast((month(o_orderdate) + 1) // 2 as int) as b,
    10000 * count(*) filter (where o_orderstatus = 'F') // count(*) as applied
    from orders group by 1, 2, 3)"""
BUDGET = f"""
select k, y, b, '{m.SPENDING_APPLIED}' as coluna, 'C1' as code, '{m.SPENDING_ACCOUNT}' as account,
    cast(applied as double) / 100 as valor from {SHARES}
union all
select k, y, b, '{m.SPENDING_MINIMUM}', 'C2', '{m.SPENDING_ACCOUNT}', 30.0 + b % 3 from {SHARES}
union all
select k, y, b, '{m.SPENDING_APPLIED}', 'C3', 'Outra conta', 1.0 from {SHARES}"""
ORACLE["stg_siops__rreo_anexo14"] = f"""
select y as ano_exercicio, 'RREO' as tipo_demonstrativo, b as periodo_bimestre,
    'B' as periodicidade, 'P ' || k as instituicao, {id7("k")} as id_municipio, 'RJ' as uf,
    cast(k * 1000 as bigint) as populacao, 'RREO-Anexo 14' as anexo, 'M' as esfera, 'R' as rotulo,
    coluna, code as codigo_conta, account as descricao_conta, cast(valor as double) as valor, {URL}
from ({BUDGET})"""
ORACLE["mart_financiamento_saude_siops"] = f"""
select {id7("k")} as id_municipio, y as ano_exercicio, b as periodo_bimestre,
    code as codigo_conta, account as descricao_conta, coluna, cast(valor as double) as valor
from ({BUDGET})"""
ORACLE["mart_alertas_saude"] = f"""
with low as (
    select {id7("k")} as id_municipio, y || '-B' || b as period,
        'Aplicado ' || applied // 100 || '.' || lpad(cast(applied % 100 as varchar), 2, '0')
        || '% no exercício, abaixo do mínimo de ' || (30 + b % 3) || '.00%' as told
    from {SHARES} where applied < 100 * (30 + b % 3)),
last as (select k, max(d) as d from {MONTHS} group by k),
gone as (
    select {id7("(k % 27)")} as id_municipio, count(*) as n from last
    where d < (select date_trunc('month', max(o_orderdate)) from orders) group by 1),
balance as (select id_municipio, ano, sum(valor) as total from ({FUNDING}) group by 1, 2),
found as (
    select '{m.RULE_SPENDING[0]}' as codigo_regra, '{m.RULE_SPENDING[1]}' as descricao_regra,
        'alta' as severidade, id_municipio, period as periodo_referencia, told as evidencia from low
    union all
    select '{m.RULE_CLOSURE[0]}', '{m.RULE_CLOSURE[1]}', 'media', id_municipio, '2025',
        n || ' estabelecimento(s) presentes em competências de 2025 mas ausentes da mais recente'
        || ' carregada' from gone
    union all
    select '{m.RULE_BALANCE[0]}', '{m.RULE_BALANCE[1]}', 'media', id_municipio,
        cast(ano as varchar), 'Saldo líquido de R$ ' || total || ' em ' || ano
    from balance where total < 0)
select md5(codigo_regra || '-' || found.id_municipio || '-' || periodo_referencia) as id_alerta,
    codigo_regra, descricao_regra, severidade, 'municipio' as tipo_entidade, found.id_municipio,
    n_name as nome_municipio, periodo_referencia, evidencia, 'ativo' as status
from found left join nation on {id7("n_nationkey")} = found.id_municipio"""

NUMBERED = f"""part left join {seed_sql("seed_sisab_tipo_indicador")}
    on codigo_tipo_indicador = (p_size % 8 + 1) * 10"""
MEASURES = """'2024Q' || (p_partkey % 3 + 1) as quadrimestre, 202412 as competencia,
    numero_indicador, descricao_indicador, p_type as visao_equipe,
    cast(p_partkey as double) as numerador, cast(p_partkey + 10 as double) as denominador_utilizador,
    cast(p_size as double) as percentual,
    cast(case when p_size <> 13 then p_size * 2 end as double) as percentual_quadrimestre,
    cast(p_partkey * 100 as bigint) as populacao"""
ORACLE["stg_sisab__indicador_desempenho"] = f"""
select 'RJ' as uf, p_name as municipio, {code6("p_partkey % 25")} as codigo_municipio, {MEASURES},
    cast((p_size % 8 + 1) * 10 as int) as codigo_tipo_indicador,
    cast(p_partkey + 5 as double) as denominador_identificado,
    cast(p_partkey + 10 as double) as denominador_estimado,
    cast(p_partkey as double) as cadastro, 1.0::double as base_externa, {URL}
from {NUMBERED}"""
ORACLE["mart_indicadores_aps"] = f"""
with rows as (select {id7("(p_partkey % 25)")} as id_municipio, {MEASURES} from {NUMBERED})
select rows.*, parametro_percentual, meta_percentual,
    case when percentual_quadrimestre is null then null
        when coalesce(percentual_quadrimestre >= parametro_percentual, false) then 'ok'
        when coalesce(percentual_quadrimestre >= meta_percentual, false) then 'atencao'
        else 'critico' end as status_meta
from rows left join {seed_sql("seed_previne_brasil_meta")}
    on seed_previne_brasil_meta.numero_indicador = rows.numero_indicador"""
WEIGHTED = "case c_custkey % 4 when 0 then true when 1 then false when 3 then false end"
ORACLE["stg_sisab__cadastro_vinculado"] = f"""
select case when c_custkey % 2 = 0 then 202412 else 202408 end as competencia_referencia,
    'RJ' as sigla_unidade_federacao, {code6("c_nationkey")} as codigo_municipio_ibge,
    'NATION_' || c_nationkey as nome_municipio,
    cast(c_nationkey * 1000 as bigint) as estimativa_populacional_ibge,
    cast({by_segment(["70", "71", "73", "74", "76"])} as int) as tipo_equipe,
    {by_segment(TEAM_NAMES)} as sigla_equipe,
    {pick(["válidas", "homologadas", "todas"], "c_custkey % 3")} as situacao_equipe,
    {WEIGHTED} as pessoas_vinculadas_com_ponderacao,
    cast(1000 + c_custkey as double) as pessoas_vinculadas_equipe_municipio, {URL}
from customer"""
ORACLE["mart_cobertura_aps_municipio"] = f"""
with places as (select * from {POPULATION} where id_municipio in (3304557, 3303807, 3303500)),
teams as (
    select {code6("c_nationkey")} as cod6, max('202512') as period,
        count(*) filter (where c_acctbal >= 0 and c_mktsegment = 'AUTOMOBILE') as esf,
        count(*) filter (where c_acctbal >= 0) as aps
    from customer where c_mktsegment <> 'BUILDING' group by 1),
linked as (
    select {code6("c_nationkey")} as cod6,
        max(case when c_custkey % 2 = 0 then 202412 else 202408 end) as period,
        sum(1000 + c_custkey) filter (where c_mktsegment = 'AUTOMOBILE' and c_custkey % 3 = 1
            and c_custkey % 2 = 1) as people
    from customer group by 1)
select id_municipio, nome_municipio, ano as ano_referencia_populacao, pop as populacao_estimada,
    teams.period as competencia_equipes_cnes, coalesce(esf, 0) as quantidade_equipes_esf_ativas,
    coalesce(aps, 0) as quantidade_equipes_aps_ativas_total,
    linked.period as competencia_cadastro_vinculado,
    cast(people as double) as populacao_vinculada_esf_homologada,
    {rounded("people", "pop", 100, 1)} as percentual_cobertura_esf
from places left join teams using (cod6) left join linked using (cod6)"""
ORACLE["mart_comparacao_municipios_rj"] = f"""
select id_municipio, nome_municipio, ano as ano_referencia_populacao, pop as populacao_estimada,
    p as competencia_rede_cnes, n as quantidade_estabelecimentos_saude,
    {rounded("n", "pop", 10000, 2)} as estabelecimentos_por_10k_habitantes,
    id_municipio in (3304557, 3303807, 3303500) as municipio_referencia
from {POPULATION} left join {NETWORK} using (cod6)"""


def _run(name: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(Workspace(spark, raw_tables(spark, folder))[name])

    return run


for _name in MODELS:
    query(_name, ORACLE[_name])(_run(_name))
