"""Dimensions, facts and decision marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municare.functions import (
    band,
    complete_category,
    count_where,
    joined,
    per_capita,
    percent,
    prefix,
    sign_label,
    signed,
    sum_where,
)
from municare.operators import (
    aggregate_then_label,
    federate_rules,
    keep_scope,
    label_pair,
    latest_per_key,
    ledger_entries,
    left_lookup,
    membership_flag,
    presence_status,
    range_lookup,
    role_lookup,
    rule,
    spread_lookup,
    union_ledgers,
)
from municare.plans.registry import SCOPE, model

BRIDGE = "int_ibge__municipio_codigo6"
TERRITORY = ("id_municipio", "nome_municipio", "id_microrregiao", "nome_microrregiao",
             "id_mesorregiao", "nome_mesorregiao", "id_uf", "sigla_uf", "nome_uf", "id_regiao",
             "sigla_regiao", "nome_regiao")

# Labels of the budget report compared by the spending rule, and rule texts.
SPENDING_ACCOUNT = (
    "Despesas com Ações e Serviços Públicos de Saúde Executadas com Recursos de Impostos"
)
SPENDING_APPLIED = "% Aplicado Até o Bimestre"
SPENDING_MINIMUM = "% Mínimo a Aplicar no Exercício"
RULE_SPENDING = (
    "siops_abaixo_minimo_constitucional",
    "Aplicação em saúde abaixo do mínimo constitucional (LC 141/2012)",
    "alta",
)
RULE_CLOSURE = (
    "rede_cnes_possivel_encerramento",
    "Estabelecimentos ausentes das competências mais recentes do CNES (possível encerramento)",
    "media",
)
RULE_BALANCE = (
    "financiamento_liquido_negativo",
    "Saldo líquido negativo em financiamento federal de saúde"
    " (estornos superam recursos recebidos)",
    "media",
)
CLOSURE_PERIOD = "2025"


@model("dim_municipio", "stg_ibge__municipios")
def municipality(municipalities: DataFrame) -> DataFrame:
    return municipalities.select(*TERRITORY)


@model(
    "dim_estabelecimento",
    "stg_cnes__estabelecimentos",
    BRIDGE,
    "stg_cnes__estabelecimentos_detalhados",
)
def facility(months: DataFrame, bridge: DataFrame, details: DataFrame) -> DataFrame:
    """Last known state of each facility, closed ones included."""
    extra = ("nome_fantasia", "endereco", "numero_endereco", "bairro", "codigo_cep", "latitude",
             "longitude", "descricao_esfera_administrativa", "descricao_turno_atendimento",
             "possui_centro_cirurgico", "possui_centro_obstetrico", "possui_centro_neonatal",
             "possui_atendimento_hospitalar")
    state = months.select(
        "codigo_cnes", "cod_municipio_ibge6", "tipo_pessoa", "nivel_dependencia",
        "codigo_tipo_unidade", "descricao_tipo_unidade", "natureza_organizacao",
        "codigo_natureza_juridica", "descricao_natureza_juridica", "atividade_ensino",
        "tem_vinculo_sus", "tipo_gestao", "esfera_administrativa",
        F.col("competencia_date").alias("competencia_cadastro"),
    )
    latest = latest_per_key(state, ["codigo_cnes"], ["competencia_cadastro"])
    placed = role_lookup(
        latest,
        bridge,
        "cod_municipio_ibge6",
        "id_municipio",
        {"cod_municipio_ibge6": "id_municipio"},
    )
    named = left_lookup(placed, details, {"codigo_cnes": "codigo_cnes"}, {c: c for c in extra})
    first = ["codigo_cnes", "id_municipio"]
    return named.select(*first, *[c for c in state.columns if c not in first], *extra)


def _place(facts: DataFrame, bridge: DataFrame, roles: dict[str, str]) -> DataFrame:
    """Swap six-digit codes for municipality ids, one join per role, order of columns kept."""
    placed = role_lookup(facts, bridge, "cod_municipio_ibge6", "id_municipio", roles)
    return placed.select(*[roles.get(c, c) for c in facts.columns])


@model("fct_internacoes", "stg_sih__internacoes", BRIDGE)
def admissions(staged: DataFrame, bridge: DataFrame) -> DataFrame:
    facts = staged.drop(
        "competencia", "_loaded_at", "_source_file", "_reference_year", "_reference_month"
    )
    return _place(
        facts,
        bridge,
        {
            "cod_municipio_ibge6_estabelecimento": "id_municipio_estabelecimento",
            "cod_municipio_ibge6_paciente": "id_municipio_paciente",
        },
    )


@model("fct_obitos", "stg_sim__obitos", BRIDGE)
def deaths(staged: DataFrame, bridge: DataFrame) -> DataFrame:
    return _place(
        staged.drop("origem_informacao", "_loaded_at", "_source_file"),
        bridge,
        {
            "cod_municipio_ibge6_ocorrencia": "id_municipio_ocorrencia",
            "cod_municipio_ibge6_residencia": "id_municipio_residencia",
        },
    )


@model("fct_nascidos_vivos", "stg_sinasc__nascidos_vivos", BRIDGE)
def births(staged: DataFrame, bridge: DataFrame) -> DataFrame:
    return _place(
        staged.drop("origem_informacao", "_loaded_at", "_source_file"),
        bridge,
        {
            "cod_municipio_ibge6_nascimento": "id_municipio_nascimento",
            "cod_municipio_ibge6_residencia": "id_municipio_residencia",
        },
    )


@model("fct_producao_ambulatorial", "stg_sia__producao_ambulatorial", BRIDGE)
def production(staged: DataFrame, bridge: DataFrame) -> DataFrame:
    """The large fact. Both joins are map-side while the bridge passes its size check."""
    return _place(
        staged.drop("competencia", "_source_file", "_reference_year", "_reference_month"),
        bridge,
        {
            "cod_municipio_ibge6_estabelecimento": "id_municipio_estabelecimento",
            "cod_municipio_ibge6_paciente": "id_municipio_paciente",
        },
    )


@model("mart_producao_grupo_municipio", "fct_producao_ambulatorial", "seed_sigtap_grupo")
def production_by_group(facts: DataFrame, groups: DataFrame) -> DataFrame:
    """Production by municipality, month and procedure group. An unknown group keeps its
    code and has no label."""
    totals = ("quantidade_produzida", "quantidade_aprovada", "valor_produzido", "valor_aprovado")
    rows = facts.filter(F.col("id_municipio_estabelecimento").isNotNull()).select(
        F.col("id_municipio_estabelecimento").alias("id_municipio"),
        "competencia_date",
        prefix("codigo_procedimento", 2).alias("codigo_grupo"),
        *totals,
    )
    keys = ["id_municipio", "competencia_date", "codigo_grupo"]
    measures = [
        F.count(F.lit(1)).alias("quantidade_registros"),
        *[F.sum(c).alias(c) for c in totals],
    ]
    labelled = aggregate_then_label(
        rows, keys, measures, "codigo_grupo", groups, "codigo_grupo",
        {"descricao_grupo": "descricao_grupo"},
    )
    return labelled.select(*keys, "descricao_grupo", "quantidade_registros", *totals)


@model("mart_icsap_municipio", "fct_internacoes", "seed_icsap_cid10")
def sensitive_share(facts: DataFrame, ranges: DataFrame) -> DataFrame:
    """Share of admissions sensitive to primary care, by residence and year of admission.

    Admissions are counted per diagnosis before the diagnosis is looked up, so the lookup
    and the last shuffle see a few rows per municipality however large the fact is.
    """
    counted = (
        facts.filter(F.col("id_municipio_paciente").isNotNull())
        .groupBy(
            F.col("id_municipio_paciente").alias("id_municipio"),
            F.year("data_internacao").alias("ano"),
            complete_category("diagnostico_principal").alias("codigo"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    resolved = range_lookup(
        counted, "codigo", ranges, "cid_inicio", "cid_fim", {"grupo_icsap": "grupo"}
    )
    sensitive = F.coalesce(sum_where("n", F.col("grupo").isNotNull()), F.lit(0))
    totals = resolved.groupBy("id_municipio", "ano").agg(
        F.sum("n").alias("total_internacoes"), sensitive.alias("total_internacoes_icsap")
    )
    return totals.withColumn(
        "percentual_icsap", percent("total_internacoes_icsap", "total_internacoes")
    )


@model(
    "mart_indicadores_aps",
    "stg_sisab__indicador_desempenho",
    BRIDGE,
    "seed_previne_brasil_meta",
)
def indicator_status(indicators: DataFrame, bridge: DataFrame, targets: DataFrame) -> DataFrame:
    rows = left_lookup(
        indicators,
        bridge,
        {"codigo_municipio": "cod_municipio_ibge6"},
        {"id_municipio": "id_municipio"},
    )
    limits = ("parametro_percentual", "meta_percentual")
    rows = left_lookup(
        rows, targets, {"numero_indicador": "numero_indicador"}, {c: c for c in limits}
    )
    status = band("percentual_quadrimestre", *limits, ("ok", "atencao", "critico"))
    return rows.select(
        "id_municipio", "quadrimestre", "competencia", "numero_indicador", "descricao_indicador",
        "visao_equipe", "numerador", "denominador_utilizador", "percentual",
        "percentual_quadrimestre", "populacao", *limits, status.alias("status_meta"),
    )


@model(
    "mart_cobertura_aps_municipio",
    "stg_ibge__populacao_estimada",
    BRIDGE,
    "stg_cnes__equipes_aps",
    "stg_sisab__cadastro_vinculado",
    SCOPE,
)
def coverage(
    population: DataFrame,
    bridge: DataFrame,
    teams: DataFrame,
    enrolment: DataFrame,
    scope: DataFrame,
) -> DataFrame:
    """Primary care coverage of the reference municipalities. Each source keeps its own
    period; missing teams count 0, a missing linked population stays unknown."""
    active = F.col("situacao_equipe") == "ativa"
    team_counts = teams.groupBy("cod_municipio_ibge6").agg(
        F.max("competencia").alias("competencia_equipes_cnes"),
        count_where(active & (F.col("sigla_equipe") == "eSF")).alias("esf"),
        count_where(active).alias("aps"),
    )
    approved = (
        (F.col("sigla_equipe") == "eSF")
        & (F.col("situacao_equipe") == "homologadas")
        & ~F.col("pessoas_vinculadas_com_ponderacao")
    )
    linked = enrolment.groupBy("codigo_municipio_ibge").agg(
        F.max("competencia_referencia").alias("competencia_cadastro_vinculado"),
        sum_where("pessoas_vinculadas_equipe_municipio", approved).alias(
            "populacao_vinculada_esf_homologada"
        ),
    )
    places = keep_scope(population, scope, {"id_municipio": "id_municipio"}).drop("nome_municipio")
    rows = places.join(bridge, "id_municipio", "inner")
    rows = left_lookup(
        rows,
        team_counts,
        {"cod_municipio_ibge6": "cod_municipio_ibge6"},
        {"competencia_equipes_cnes": "competencia_equipes_cnes", "esf": "esf", "aps": "aps"},
    )
    rows = left_lookup(
        rows,
        linked,
        {"cod_municipio_ibge6": "codigo_municipio_ibge"},
        {c: c for c in linked.columns if c != "codigo_municipio_ibge"},
    )
    return rows.select(
        "id_municipio",
        "nome_municipio",
        F.col("ano_referencia").alias("ano_referencia_populacao"),
        "populacao_estimada",
        "competencia_equipes_cnes",
        F.coalesce("esf", F.lit(0)).alias("quantidade_equipes_esf_ativas"),
        F.coalesce("aps", F.lit(0)).alias("quantidade_equipes_aps_ativas_total"),
        "competencia_cadastro_vinculado",
        "populacao_vinculada_esf_homologada",
        percent("populacao_vinculada_esf_homologada", "populacao_estimada").alias(
            "percentual_cobertura_esf"
        ),
    )


@model(
    "mart_comparacao_municipios_rj",
    "stg_ibge__populacao_estimada",
    BRIDGE,
    "stg_cnes__rede_porte_municipio",
    SCOPE,
)
def peers(
    population: DataFrame, bridge: DataFrame, network: DataFrame, scope: DataFrame
) -> DataFrame:
    """Every municipality of the state with its population and facilities per 10,000
    inhabitants; one row per network period present."""
    rows = population.join(
        bridge.select("id_municipio", "cod_municipio_ibge6"), "id_municipio", "inner"
    )
    rows = left_lookup(
        rows,
        network,
        {"cod_municipio_ibge6": "cod_municipio_ibge6"},
        {
            "competencia": "competencia_rede_cnes",
            "quantidade_estabelecimentos": "quantidade_estabelecimentos_saude",
        },
    )
    rows = membership_flag(rows, scope, {"id_municipio": "id_municipio"}, "municipio_referencia")
    return rows.select(
        "id_municipio",
        "nome_municipio",
        F.col("ano_referencia").alias("ano_referencia_populacao"),
        "populacao_estimada",
        "competencia_rede_cnes",
        "quantidade_estabelecimentos_saude",
        per_capita("quantidade_estabelecimentos_saude", "populacao_estimada", 10_000, 2).alias(
            "estabelecimentos_por_10k_habitantes"
        ),
        "municipio_referencia",
    )


@model("mart_equipe_aps_detalhada", "stg_cnes__equipes_aps", "dim_estabelecimento", BRIDGE)
def team_listing(teams: DataFrame, facilities: DataFrame, bridge: DataFrame) -> DataFrame:
    """One row per care team with its facility and municipality; nothing is aggregated."""
    rows = spread_lookup(
        teams,
        facilities,
        {"codigo_cnes": "codigo_cnes"},
        {
            "descricao_tipo_unidade": "descricao_tipo_unidade",
            "nome_fantasia": "nome_unidade",
            "endereco": "endereco",
            "bairro": "bairro",
        },
    ).join(bridge, "cod_municipio_ibge6", "inner")
    return rows.select(
        "id_equipe", "sigla_equipe", "nome_equipe", "situacao_equipe", "competencia",
        "codigo_cnes", "descricao_tipo_unidade", "nome_unidade", "endereco", "bairro",
        "id_municipio", "nome_municipio", "id_area", "nome_area", "id_segmento",
        "descricao_segmento", "tipo_segmento",
    )


@model("mart_financiamento_saude_siops", "stg_siops__rreo_anexo14")
def budget(report: DataFrame) -> DataFrame:
    return report.select(
        "id_municipio", "ano_exercicio", "periodo_bimestre", "codigo_conta", "descricao_conta",
        "coluna", "valor",
    )


@model("mart_repasses_fns", "stg_fns__repasses", "seed_fns_ente_municipio")
def transfers(ledger: DataFrame, entities: DataFrame) -> DataFrame:
    rows = left_lookup(
        ledger,
        entities,
        {"cnpj_ente_solicitante": "cnpj_ente"},
        {"id_municipio": "id_municipio"},
    )
    return rows.select(
        "id_lancamento", "id_municipio", "cnpj_ente_solicitante", "nome_ente_solicitante",
        "tipo_operacao", "descricao_lancamento", "data_lancamento", "valor_lancamento",
        F.year("data_lancamento").alias("ano"),
    )


@model(
    "mart_financiamento_saude_uniao",
    "stg_fns__repasses",
    "stg_portaltransparencia__recursos_recebidos",
    "seed_fns_ente_municipio",
)
def funding(ledger: DataFrame, receipts: DataFrame, entities: DataFrame) -> DataFrame:
    """Two federal ledgers in one signed shape: debits turn negative, receipts are signed
    at the source."""
    place = {"id_municipio": "id_municipio"}
    fund = left_lookup(ledger, entities, {"cnpj_ente_solicitante": "cnpj_ente"}, place)
    portal = left_lookup(receipts, entities, {"cnpj_favorecido": "cnpj_ente"}, place)
    return union_ledgers(
        ledger_entries(
            fund,
            "fns_fundo_a_fundo",
            id_municipio=F.col("id_municipio"),
            data_referencia=F.col("data_lancamento"),
            ano=F.year("data_lancamento"),
            tipo_lancamento=F.col("tipo_operacao"),
            descricao_origem=F.col("descricao_lancamento"),
            valor=signed("valor_lancamento", "tipo_operacao", "debito"),
        ),
        ledger_entries(
            portal,
            "portal_transparencia",
            id_municipio=F.col("id_municipio"),
            data_referencia=F.col("competencia_date"),
            ano=F.col("_reference_year"),
            tipo_lancamento=sign_label("valor", "recurso", "estorno"),
            descricao_origem=joined(" - ", "nome_orgao_superior", "nome_ug"),
            valor=F.col("valor"),
        ),
    )


@model("mart_historico_rede_cnes", "stg_cnes__estabelecimentos", BRIDGE)
def network_history(months: DataFrame, bridge: DataFrame) -> DataFrame:
    """Every facility month with what its presence says about the facility."""
    rows = months.select(
        "id_estabelecimento_competencia", "codigo_cnes", "cod_municipio_ibge6",
        F.col("competencia_date").alias("competencia_cadastro"),
        "codigo_tipo_unidade", "descricao_tipo_unidade", "tipo_gestao",
    )
    placed = _place(
        presence_status(rows, "codigo_cnes", "competencia_cadastro"),
        bridge,
        {"cod_municipio_ibge6": "id_municipio"},
    )
    return placed.select(
        "id_estabelecimento_competencia", "codigo_cnes", "id_municipio", "competencia_cadastro",
        "codigo_tipo_unidade", "descricao_tipo_unidade", "tipo_gestao",
        "primeira_competencia_observada", "ultima_competencia_observada", "situacao_operacional",
    )


def spending_alerts(report: DataFrame) -> DataFrame:
    keys = ["id_municipio", "ano_exercicio", "periodo_bimestre"]
    pairs = label_pair(
        report.filter(F.col("descricao_conta") == SPENDING_ACCOUNT),
        keys,
        "coluna",
        "valor",
        (SPENDING_APPLIED, "aplicado"),
        (SPENDING_MINIMUM, "minimo"),
    )
    told = F.concat(
        F.lit("Aplicado "), F.col("aplicado").cast("string"),
        F.lit("% no exercício, abaixo do mínimo de "), F.col("minimo").cast("string"), F.lit("%"),
    )
    return rule(
        pairs.filter(F.col("aplicado") < F.col("minimo")),
        *RULE_SPENDING,
        period=joined("-B", "ano_exercicio", "periodo_bimestre"),
        evidence=told,
    )


def closure_alerts(history: DataFrame) -> DataFrame:
    gone = history.filter(F.col("situacao_operacional") == "possivelmente_encerrado")
    counted = gone.groupBy("id_municipio").agg(F.countDistinct("codigo_cnes").alias("n"))
    told = F.concat(
        F.col("n").cast("string"),
        F.lit(
            f" estabelecimento(s) presentes em competências de {CLOSURE_PERIOD}"
            " mas ausentes da mais recente carregada"
        ),
    )
    return rule(counted, *RULE_CLOSURE, period=F.lit(CLOSURE_PERIOD), evidence=told)


def balance_alerts(ledger: DataFrame) -> DataFrame:
    balance = ledger.groupBy("id_municipio", "ano").agg(F.sum("valor").alias("saldo"))
    year = F.col("ano").cast("string")
    told = F.concat(
        F.lit("Saldo líquido de R$ "), F.round("saldo", 2).cast("string"), F.lit(" em "), year
    )
    return rule(balance.filter("saldo < 0"), *RULE_BALANCE, period=year, evidence=told)


@model(
    "mart_alertas_saude",
    "mart_financiamento_saude_siops",
    "mart_historico_rede_cnes",
    "mart_financiamento_saude_uniao",
    BRIDGE,
)
def alerts(
    report: DataFrame, history: DataFrame, ledger: DataFrame, municipalities: DataFrame
) -> DataFrame:
    return federate_rules(
        [spending_alerts(report), closure_alerts(history), balance_alerts(ledger)], municipalities
    )
