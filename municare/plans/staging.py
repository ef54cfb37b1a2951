"""Staging views: typed columns and decoded codes over the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municare.functions import (
    age_unit,
    age_value,
    blank_to_null,
    day_brazilian,
    day_compact,
    flag,
    is_code,
    joined,
    label,
    period_start,
    sentinel_status,
    to_int,
    to_money,
    unreadable,
)
from municare.operators import left_lookup
from municare.plans.registry import model

# Codes of the facility, team and ledger registers.
PERSON_TYPES = {"1": "fisica", "3": "juridica"}
DEPENDENCY_LEVELS = {"1": "individual", "3": "mantida"}
TEACHING_ACTIVITIES = {
    "01": "unidade_universitaria",
    "02": "unidade_escola_superior_isolada",
    "03": "unidade_auxiliar_de_ensino",
    "04": "sem_atividade_de_ensino",
    "05": "hospital_de_ensino",
}
MANAGEMENT_TYPES = {"M": "municipal", "E": "estadual", "D": "dupla", "S": "sem_gestao"}
TEAM_ACRONYMS = {"70": "eSF", "73": "eCR", "74": "eAPP", "76": "eAP"}
STILL_ACTIVE = "900001"
LEDGER_OPERATIONS = {"C": "credito", "D": "debito"}
NOT_INFORMED = "nao_informado"
AGE_NOT_INFORMED = "999"


@model("stg_ibge__municipios", "raw_ibge.municipios")
def municipalities(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id_municipio", "nome_municipio",
        "id_microrregiao", "nome_microrregiao",
        "id_mesorregiao", "nome_mesorregiao",
        "id_uf", "sigla_uf", "nome_uf",
        "id_regiao", "sigla_regiao", "nome_regiao",
        "_loaded_at", "_source_url",
    )


@model("stg_ibge__populacao_estimada", "raw_ibge.populacao_estimada")
def population(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id_municipio", "nome_municipio", "ano_referencia", "populacao_estimada",
        "_loaded_at", "_source_url",
    )


@model(
    "stg_cnes__estabelecimentos",
    "raw_cnes.estabelecimentos",
    "seed_cnes_natureza_juridica",
    "seed_cnes_tipo_unidade",
)
def facilities(raw: DataFrame, legal_natures: DataFrame, unit_types: DataFrame) -> DataFrame:
    """Facility by month. The administrative sphere stays raw: its codes do not follow the
    published domain."""
    rows = left_lookup(
        raw,
        unit_types,
        {"tipo_unidade": "codigo_tipo_unidade"},
        {"descricao_tipo_unidade": "descricao_tipo_unidade"},
    )
    rows = left_lookup(
        rows,
        legal_natures,
        {"natureza_juridica": "codigo_natureza_juridica"},
        {"descricao_natureza_juridica": "descricao_natureza_juridica"},
    )
    return rows.select(
        joined("-", "codigo_cnes", "competencia").alias("id_estabelecimento_competencia"),
        "codigo_cnes",
        "cod_municipio_ibge6",
        label("tipo_pessoa", PERSON_TYPES).alias("tipo_pessoa"),
        label("nivel_dependencia", DEPENDENCY_LEVELS).alias("nivel_dependencia"),
        F.col("tipo_unidade").alias("codigo_tipo_unidade"),
        "descricao_tipo_unidade",
        blank_to_null("natureza_organizacao").alias("natureza_organizacao"),
        F.col("natureza_juridica").alias("codigo_natureza_juridica"),
        "descricao_natureza_juridica",
        label("atividade_ensino", TEACHING_ACTIVITIES, NOT_INFORMED).alias("atividade_ensino"),
        flag("vinculo_sus", yes="1", no="0").alias("tem_vinculo_sus"),
        label("tipo_gestao", MANAGEMENT_TYPES, NOT_INFORMED).alias("tipo_gestao"),
        "esfera_administrativa",
        "competencia",
        period_start("competencia").alias("competencia_date"),
        "data_atualizacao",
        "_loaded_at", "_source_file", "_reference_year", "_reference_month",
    )


@model("stg_cnes__estabelecimentos_detalhados", "raw_cnes.estabelecimentos_detalhados")
def facility_details(raw: DataFrame) -> DataFrame:
    """Live register: name, address, position and services of a facility."""
    services = ("possui_centro_cirurgico", "possui_centro_obstetrico", "possui_centro_neonatal",
                "possui_atendimento_hospitalar", "possui_servico_apoio",
                "possui_atendimento_ambulatorial")
    return raw.select(
        "codigo_cnes", "nome_razao_social", "nome_fantasia", "codigo_tipo_unidade", "codigo_cep",
        "endereco", "numero_endereco", "bairro", "numero_telefone", "latitude", "longitude",
        "email", "descricao_turno_atendimento",
        flag("faz_atendimento_ambulatorial_sus", yes="SIM", no="NAO").alias(
            "faz_atendimento_ambulatorial_sus"
        ),
        "descricao_esfera_administrativa", "codigo_motivo_desabilitacao",
        *[is_code(c, 1).alias(c) for c in services],
        "data_atualizacao", "_loaded_at", "_source_url",
    )


@model("stg_cnes__equipes_aps", "raw_cnes.equipes_aps")
def care_teams(raw: DataFrame) -> DataFrame:
    ended = "competencia_desativacao"
    return raw.select(
        "id_equipe", "codigo_cnes", "cod_municipio_ibge6", "codigo_tipo_equipe",
        label("codigo_tipo_equipe", TEAM_ACRONYMS).alias("sigla_equipe"),
        "nome_equipe", "competencia_ativacao", ended,
        sentinel_status(ended, STILL_ACTIVE, "ativa", "desativada").alias("situacao_equipe"),
        "motivo_desativacao", "competencia", "id_area", "nome_area", "id_segmento",
        "descricao_segmento", "tipo_segmento",
        "_loaded_at", "_source_file", "_reference_year", "_reference_month",
    )


@model("stg_cnes__rede_porte_municipio", "raw_cnes.rede_porte_municipio")
def network_size(raw: DataFrame) -> DataFrame:
    return raw.select(
        "cod_municipio_ibge6", "competencia", "quantidade_estabelecimentos",
        "_loaded_at", "_source_file",
    )


def production(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Ambulatory production. ``strict=False`` gives NULL for unreadable numbers and dates;
    ``quarantine`` counts what that loses."""
    return raw.select(
        "codigo_cnes_estabelecimento",
        "cod_municipio_ibge6_estabelecimento", "cod_municipio_ibge6_paciente",
        "competencia",
        period_start("competencia", strict).alias("competencia_date"),
        "competencia_arquivo", "codigo_procedimento", "codigo_cbo", "carater_atendimento",
        to_int(blank_to_null("idade_paciente", AGE_NOT_INFORMED), strict).alias("idade_paciente"),
        "sexo_paciente", "raca_cor_paciente",
        to_int("quantidade_produzida", strict).alias("quantidade_produzida"),
        to_int("quantidade_aprovada", strict).alias("quantidade_aprovada"),
        to_money("valor_produzido", strict).alias("valor_produzido"),
        to_money("valor_aprovado", strict).alias("valor_aprovado"),
        "origem_documento", "_loaded_at", "_source_file", "_reference_year", "_reference_month",
    )


model("stg_sia__producao_ambulatorial", "raw_sia.producao_ambulatorial")(production)


def admissions(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Hospital admissions; the patient's age is kept as the source writes it."""
    return raw.select(
        "numero_aih", "codigo_cnes_estabelecimento",
        "cod_municipio_ibge6_estabelecimento", "cod_municipio_ibge6_paciente",
        "competencia",
        period_start("competencia", strict).alias("competencia_date"),
        "codigo_procedimento", "codigo_cbo", "idade_paciente", "sexo_paciente",
        "raca_cor_paciente", "diagnostico_principal",
        to_money("valor_total", strict).alias("valor_total"),
        day_compact("data_internacao", strict).alias("data_internacao"),
        day_compact("data_saida", strict).alias("data_saida"),
        to_int("dias_permanencia", strict).alias("dias_permanencia"),
        is_code("indicador_obito", "1").alias("houve_obito"),
        "_loaded_at", "_source_file", "_reference_year", "_reference_month",
    )


model("stg_sih__internacoes", "raw_sih.internacoes")(admissions)


def deaths(raw: DataFrame, strict: bool = True) -> DataFrame:
    return raw.select(
        "origem_informacao", "codigo_cnes_estabelecimento",
        "cod_municipio_ibge6_ocorrencia", "cod_municipio_ibge6_residencia",
        day_brazilian("data_obito", strict).alias("data_obito"),
        day_brazilian("data_nascimento", strict).alias("data_nascimento"),
        age_unit("idade").alias("idade_unidade"),
        age_value("idade", strict).alias("idade_valor"),
        "sexo", "raca_cor", "estado_civil", "escolaridade", "local_ocorrencia", "causa_basica",
        "circunstancia_obito", "assistencia_medica",
        "_loaded_at", "_source_file", "_reference_year",
    )


model("stg_sim__obitos", "raw_sim.obitos")(deaths)


def births(raw: DataFrame, strict: bool = True) -> DataFrame:
    return raw.select(
        "origem_informacao", "codigo_cnes_estabelecimento",
        "cod_municipio_ibge6_nascimento", "cod_municipio_ibge6_residencia",
        day_brazilian("data_nascimento", strict).alias("data_nascimento"),
        "sexo", "raca_cor",
        to_int("peso_gramas", strict).alias("peso_gramas"),
        "semanas_gestacao_faixa", "tipo_parto",
        to_int(blank_to_null("apgar1"), strict).alias("apgar1"),
        to_int(blank_to_null("apgar5"), strict).alias("apgar5"),
        to_int("numero_consultas_prenatal", strict).alias("numero_consultas_prenatal"),
        to_int("idade_mae", strict).alias("idade_mae"),
        "escolaridade_mae", "_loaded_at", "_source_file", "_reference_year",
    )


model("stg_sinasc__nascidos_vivos", "raw_sinasc.nascidos_vivos")(births)


@model("stg_fns__repasses", "raw_fns.repasses")
def fund_transfers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id_lancamento", "cnpj_ente_solicitante", "nome_ente_solicitante", "codigo_programa_agil",
        label("tipo_operacao", LEDGER_OPERATIONS).alias("tipo_operacao"),
        "descricao_tipo_operacao", "descricao_lancamento", "data_lancamento",
        "data_evento_lancamento", "numero_referencia_unica", "tipo_favorecido",
        "descricao_tipo_favorecido", "nome_favorecido", "valor_lancamento",
        "id_categoria_despesa", "quantidade_subtransacoes",
        "_loaded_at", "_source_url", "_reference_year",
    )


@model(
    "stg_portaltransparencia__recursos_recebidos",
    "raw_portaltransparencia.recursos_recebidos_saude",
)
def receipts(raw: DataFrame) -> DataFrame:
    """Federal receipts; a negative value is a reversal and stays negative."""
    return raw.select(
        "competencia",
        period_start("competencia").alias("competencia_date"),
        "cnpj_favorecido", "nome_favorecido", "tipo_favorecido", "municipio_favorecido",
        "sigla_uf_favorecido", "codigo_ug", "nome_ug", "codigo_orgao", "nome_orgao",
        "codigo_orgao_superior", "nome_orgao_superior", "valor",
        "_loaded_at", "_source_url", "_reference_year",
    )


@model("stg_siops__rreo_anexo14", "raw_siops.rreo_anexo14")
def budget_report(raw: DataFrame) -> DataFrame:
    return raw.select(
        "ano_exercicio", "tipo_demonstrativo", "periodo_bimestre", "periodicidade", "instituicao",
        "id_municipio", "uf", "populacao", "anexo", "esfera", "rotulo", "coluna", "codigo_conta",
        "descricao_conta", "valor", "_loaded_at", "_source_url",
    )


@model(
    "stg_sisab__indicador_desempenho", "raw_sisab.indicador_desempenho", "seed_sisab_tipo_indicador"
)
def indicators(raw: DataFrame, names: DataFrame) -> DataFrame:
    rows = left_lookup(
        raw,
        names,
        {"codigo_tipo_indicador": "codigo_tipo_indicador"},
        {"numero_indicador": "numero_indicador", "descricao_indicador": "descricao_indicador"},
    )
    return rows.select(
        "uf", "municipio",
        F.col("codigo_municipio").cast("string").alias("codigo_municipio"),
        "quadrimestre", "competencia", "codigo_tipo_indicador", "numero_indicador",
        "descricao_indicador", "visao_equipe", "numerador", "denominador_utilizador",
        "denominador_identificado", "denominador_estimado", "percentual",
        "percentual_quadrimestre", "cadastro", "base_externa", "populacao",
        "_loaded_at", "_source_url",
    )


@model("stg_sisab__cadastro_vinculado", "raw_sisab.cadastro_vinculado")
def enrolment(raw: DataFrame) -> DataFrame:
    weighting = flag("pessoas_vinculadas_criterios_ponderacao", yes="Sim", no="Não")
    return raw.select(
        "competencia_referencia", "sigla_unidade_federacao",
        F.col("codigo_municipio_ibge").cast("string").alias("codigo_municipio_ibge"),
        "nome_municipio", "estimativa_populacional_ibge", "tipo_equipe", "sigla_equipe",
        "situacao_equipe",
        weighting.alias("pessoas_vinculadas_com_ponderacao"),
        "pessoas_vinculadas_equipe_municipio", "_loaded_at", "_source_url",
    )


# What a tolerant load turns into NULL, per source: column -> parsed expression.
TOLERANT = {
    "raw_sia.producao_ambulatorial": lambda: {
        "competencia": period_start("competencia", False),
        "idade_paciente": to_int("idade_paciente", False),
        "quantidade_produzida": to_int("quantidade_produzida", False),
        "quantidade_aprovada": to_int("quantidade_aprovada", False),
        "valor_produzido": to_money("valor_produzido", False),
        "valor_aprovado": to_money("valor_aprovado", False),
    },
    "raw_sih.internacoes": lambda: {
        "competencia": period_start("competencia", False),
        "valor_total": to_money("valor_total", False),
        "data_internacao": day_compact("data_internacao", False),
        "data_saida": day_compact("data_saida", False),
        "dias_permanencia": to_int("dias_permanencia", False),
    },
    "raw_sim.obitos": lambda: {
        "data_obito": day_brazilian("data_obito", False),
        "data_nascimento": day_brazilian("data_nascimento", False),
        "idade": age_value(F.nullif(F.nullif(F.col("idade"), F.lit("000")), F.lit("999")), False),
    },
    "raw_sinasc.nascidos_vivos": lambda: {
        "data_nascimento": day_brazilian("data_nascimento", False),
        "peso_gramas": to_int("peso_gramas", False),
        "apgar1": to_int("apgar1", False),
        "apgar5": to_int("apgar5", False),
        "numero_consultas_prenatal": to_int("numero_consultas_prenatal", False),
        "idade_mae": to_int("idade_mae", False),
    },
}


def quarantine(raw: DataFrame, table: str) -> DataFrame:
    """(column, unreadable): values a tolerant load of this source turns into NULL, counted
    in one pass."""
    counted: list[Column] = []
    for column, parsed in TOLERANT[table]().items():
        lost = unreadable(column, parsed)
        if table == "raw_sim.obitos" and column == "idade":
            lost = lost & ~F.col(column).isin("000", "999")
        counted.append(
            F.struct(F.lit(column).alias("column"), F.count_if(lost).alias("unreadable"))
        )
    return raw.agg(F.array(*counted).alias("counted")).select(F.inline("counted"))
