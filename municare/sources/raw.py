"""The fifteen raw tables: what each source must hold and how it is normalised."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municare.functions import digits_only, join_period, zero_pad
from municare.sources.landing import POSITION, SOURCE_FILE
from municare.sources.lookups import REFERENCE_CODES
from municare.sources.validate import must, require_columns, require_fields

# Care team types that count as primary care.
PRIMARY_CARE_TEAM_TYPES = ("70", "73", "74", "76")


@dataclass(frozen=True)
class Source:
    """Contract of one source: field -> raw column, plus what differs from a plain rename."""

    table: str
    fields: Mapping[str, str]
    optional: Mapping[str, str] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)
    computed: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    scope: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    write: str = "upsert"
    keys: tuple[str, ...] = ()


# Field names of the public layouts and the raw columns they fill.
FACILITY_FIELDS = {
    "CNES": "codigo_cnes",
    "CODUFMUN": "cod_municipio_ibge6",
    "PF_PJ": "tipo_pessoa",
    "NIV_DEP": "nivel_dependencia",
    "TP_UNID": "tipo_unidade",
    "NATUREZA": "natureza_organizacao",
    "NAT_JUR": "natureza_juridica",
    "ATIVIDAD": "atividade_ensino",
    "VINC_SUS": "vinculo_sus",
    "TPGESTAO": "tipo_gestao",
    "ESFERA_A": "esfera_administrativa",
    "COMPETEN": "competencia",
    "DT_ATUAL": "data_atualizacao",
}
TEAM_FIELDS = {
    "IDEQUIPE": "id_equipe",
    "CNES": "codigo_cnes",
    "CODUFMUN": "cod_municipio_ibge6",
    "TIPO_EQP": "codigo_tipo_equipe",
    "NOME_EQP": "nome_equipe",
    "DT_ATIVA": "competencia_ativacao",
    "DT_DESAT": "competencia_desativacao",
    "MOTDESAT": "motivo_desativacao",
    "TP_DESAT": "tipo_desativacao",
    "COMPETEN": "competencia",
    "ID_AREA": "id_area",
    "NOMEAREA": "nome_area",
    "ID_SEGM": "id_segmento",
    "DESCSEGM": "descricao_segmento",
    "TIPOSEGM": "tipo_segmento",
}
FACILITY_DETAIL_FIELDS = {
    "nome_razao_social": "nome_razao_social",
    "nome_fantasia": "nome_fantasia",
    "codigo_tipo_unidade": "codigo_tipo_unidade",
    "codigo_cep_estabelecimento": "codigo_cep",
    "endereco_estabelecimento": "endereco",
    "numero_estabelecimento": "numero_endereco",
    "bairro_estabelecimento": "bairro",
    "numero_telefone_estabelecimento": "numero_telefone",
    "latitude_estabelecimento_decimo_grau": "latitude",
    "longitude_estabelecimento_decimo_grau": "longitude",
    "endereco_email_estabelecimento": "email",
    "descricao_turno_atendimento": "descricao_turno_atendimento",
    "estabelecimento_faz_atendimento_ambulatorial_sus": "faz_atendimento_ambulatorial_sus",
    "descricao_esfera_administrativa": "descricao_esfera_administrativa",
    "codigo_motivo_desabilitacao_estabelecimento": "codigo_motivo_desabilitacao",
    "estabelecimento_possui_centro_cirurgico": "possui_centro_cirurgico",
    "estabelecimento_possui_centro_obstetrico": "possui_centro_obstetrico",
    "estabelecimento_possui_centro_neonatal": "possui_centro_neonatal",
    "estabelecimento_possui_atendimento_hospitalar": "possui_atendimento_hospitalar",
    "estabelecimento_possui_servico_apoio": "possui_servico_apoio",
    "estabelecimento_possui_atendimento_ambulatorial": "possui_atendimento_ambulatorial",
    "data_atualizacao": "data_atualizacao",
}
PRODUCTION_FIELDS = {
    "PA_CODUNI": "codigo_cnes_estabelecimento",
    "PA_UFMUN": "cod_municipio_ibge6_estabelecimento",
    "PA_MUNPCN": "cod_municipio_ibge6_paciente",
    "PA_CMP": "competencia",
    "PA_PROC_ID": "codigo_procedimento",
    "PA_CBOCOD": "codigo_cbo",
    "PA_CATEND": "carater_atendimento",
    "PA_IDADE": "idade_paciente",
    "PA_SEXO": "sexo_paciente",
    "PA_RACACOR": "raca_cor_paciente",
    "PA_QTDPRO": "quantidade_produzida",
    "PA_QTDAPR": "quantidade_aprovada",
    "PA_VALPRO": "valor_produzido",
    "PA_VALAPR": "valor_aprovado",
    "PA_DOCORIG": "origem_documento",
}
ADMISSION_FIELDS = {
    "N_AIH": "numero_aih",
    "CNES": "codigo_cnes_estabelecimento",
    "MUNIC_MOV": "cod_municipio_ibge6_estabelecimento",
    "MUNIC_RES": "cod_municipio_ibge6_paciente",
    "PROC_REA": "codigo_procedimento",
    "CBOR": "codigo_cbo",
    "IDADE": "idade_paciente",
    "SEXO": "sexo_paciente",
    "RACA_COR": "raca_cor_paciente",
    "DIAG_PRINC": "diagnostico_principal",
    "VAL_TOT": "valor_total",
    "DT_INTER": "data_internacao",
    "DT_SAIDA": "data_saida",
    "DIAS_PERM": "dias_permanencia",
    "MORTE": "indicador_obito",
}
DEATH_FIELDS = {
    "ORIGEM": "origem_informacao",
    "CODESTAB": "codigo_cnes_estabelecimento",
    "CODMUNOCOR": "cod_municipio_ibge6_ocorrencia",
    "CODMUNRES": "cod_municipio_ibge6_residencia",
    "DTOBITO": "data_obito",
    "DTNASC": "data_nascimento",
    "IDADE": "idade",
    "SEXO": "sexo",
    "RACACOR": "raca_cor",
    "ESTCIV": "estado_civil",
    "ESC": "escolaridade",
    "LOCOCOR": "local_ocorrencia",
    "CAUSABAS": "causa_basica",
    "CIRCOBITO": "circunstancia_obito",
    "ASSISTMED": "assistencia_medica",
}
BIRTH_FIELDS = {
    "ORIGEM": "origem_informacao",
    "CODESTAB": "codigo_cnes_estabelecimento",
    "CODMUNNASC": "cod_municipio_ibge6_nascimento",
    "CODMUNRES": "cod_municipio_ibge6_residencia",
    "DTNASC": "data_nascimento",
    "SEXO": "sexo",
    "RACACOR": "raca_cor",
    "PESO": "peso_gramas",
    "GESTACAO": "semanas_gestacao_faixa",
    "PARTO": "tipo_parto",
    "APGAR1": "apgar1",
    "APGAR5": "apgar5",
    "CONSULTAS": "numero_consultas_prenatal",
    "IDADEMAE": "idade_mae",
    "ESCMAE": "escolaridade_mae",
}
FUND_FIELDS = {
    "id_lancamento_gestao_financeira": "id_lancamento",
    "cnpj_ente_solicitante_gestao_financeira": "cnpj_ente_solicitante",
    "nome_ente_solicitante_gestao_financeira": "nome_ente_solicitante",
    "tipo_operacao_gestao_financeira": "tipo_operacao",
    "descricao_tipo_operacao_gestao_financeira": "descricao_tipo_operacao",
    "descricao_gestao_financeira": "descricao_lancamento",
    "data_lancamento_gestao_financeira": "data_lancamento",
    "data_evento_lancamento_gestao_financeira": "data_evento_lancamento",
    "valor_lancamento_gestao_financeira": "valor_lancamento",
}
FUND_OPTIONAL_FIELDS = {
    "codigo_programa_agil_ente_solicitante_gestao_financeira": "codigo_programa_agil",
    "numero_referencia_unica_gestao_financeira": "numero_referencia_unica",
    "tipo_favorecido_gestao_financeira": "tipo_favorecido",
    "descricao_tipo_favorecido_gestao_financeira": "descricao_tipo_favorecido",
    "nome_favorecido_gestao_financeira": "nome_favorecido",
    "id_categoria_despesa_gestao_financeira": "id_categoria_despesa",
    "quantidade_subtransacoes_lancamento_gestao_financeira": "quantidade_subtransacoes",
}
RECEIPT_FIELDS = {
    "anoMes": "competencia",
    "codigoPessoa": "cnpj_favorecido",
    "nomePessoa": "nome_favorecido",
    "tipoPessoa": "tipo_favorecido",
    "municipioPessoa": "municipio_favorecido",
    "siglaUFPessoa": "sigla_uf_favorecido",
    "codigoUG": "codigo_ug",
    "nomeUG": "nome_ug",
    "codigoOrgao": "codigo_orgao",
    "nomeOrgao": "nome_orgao",
    "codigoOrgaoSuperior": "codigo_orgao_superior",
    "nomeOrgaoSuperior": "nome_orgao_superior",
    "valor": "valor",
}
BUDGET_FIELDS = {
    "exercicio": "ano_exercicio",
    "demonstrativo": "tipo_demonstrativo",
    "periodo": "periodo_bimestre",
    "periodicidade": "periodicidade",
    "instituicao": "instituicao",
    "cod_ibge": "id_municipio",
    "uf": "uf",
    "populacao": "populacao",
    "anexo": "anexo",
    "esfera": "esfera",
    "rotulo": "rotulo",
    "coluna": "coluna",
    "cod_conta": "codigo_conta",
    "conta": "descricao_conta",
    "valor": "valor",
}
INDICATOR_FIELDS = (
    "uf",
    "municipio",
    "codigo_municipio",
    "quadrimestre",
    "competencia",
    "codigo_tipo_indicador",
    "visao_equipe",
    "numerador",
    "denominador_utilizador",
    "denominador_identificado",
    "denominador_estimado",
    "percentual",
    "percentual_quadrimestre",
    "cadastro",
    "base_externa",
    "populacao",
)
ENROLMENT_FIELDS = (
    "competencia_referencia",
    "sigla_unidade_federacao",
    "codigo_municipio_ibge",
    "nome_municipio",
    "estimativa_populacional_ibge",
    "tipo_equipe",
    "sigla_equipe",
    "situacao_equipe",
    "pessoas_vinculadas_criterios_ponderacao",
    "pessoas_vinculadas_equipe_municipio",
)

MONEY = "decimal(18,2)"
RATE = "decimal(18,4)"

SOURCES = {
    s.table: s
    for s in (
        Source(
            "raw_cnes.estabelecimentos",
            FACILITY_FIELDS,
            scope={"CODUFMUN": REFERENCE_CODES},
            keys=("codigo_cnes", "competencia"),
        ),
        Source(
            "raw_cnes.equipes_aps",
            TEAM_FIELDS,
            scope={"CODUFMUN": REFERENCE_CODES, "TIPO_EQP": PRIMARY_CARE_TEAM_TYPES},
            keys=("id_equipe",),
        ),
        Source(
            "raw_cnes.estabelecimentos_detalhados",
            {"codigo_cnes": "codigo_cnes"},
            optional=FACILITY_DETAIL_FIELDS,
            types={
                "latitude": "decimal(12,8)",
                "longitude": "decimal(12,8)",
                **{c: "int" for c in FACILITY_DETAIL_FIELDS.values() if c.startswith("possui_")},
            },
            computed={"codigo_cnes": lambda: zero_pad("codigo_cnes", 7)},
            keys=("codigo_cnes",),
        ),
        Source(
            "raw_sia.producao_ambulatorial",
            PRODUCTION_FIELDS,
            write="replace",
            keys=("competencia_arquivo",),
        ),
        Source(
            "raw_sih.internacoes",
            {**ADMISSION_FIELDS, "ANO_CMPT": "competencia", "MES_CMPT": "competencia"},
            computed={"competencia": lambda: join_period("ANO_CMPT", "MES_CMPT")},
            scope={"MUNIC_MOV": REFERENCE_CODES},
            keys=("numero_aih",),
        ),
        Source(
            "raw_sim.obitos",
            DEATH_FIELDS,
            scope={"CODMUNOCOR": REFERENCE_CODES},
            write="replace",
            keys=("_reference_year", "cod_municipio_ibge6_ocorrencia"),
        ),
        Source(
            "raw_sinasc.nascidos_vivos",
            BIRTH_FIELDS,
            scope={"CODMUNNASC": REFERENCE_CODES},
            write="replace",
            keys=("_reference_year", "cod_municipio_ibge6_nascimento"),
        ),
        Source(
            "raw_fns.repasses",
            FUND_FIELDS,
            optional=FUND_OPTIONAL_FIELDS,
            types={
                "id_lancamento": "bigint",
                "data_lancamento": "date",
                "data_evento_lancamento": "date",
                "valor_lancamento": MONEY,
                "tipo_favorecido": "int",
                "id_categoria_despesa": "int",
                "quantidade_subtransacoes": "int",
            },
            keys=("id_lancamento",),
        ),
        Source(
            "raw_portaltransparencia.recursos_recebidos_saude",
            RECEIPT_FIELDS,
            types={"competencia": "int", "valor": MONEY},
            computed={"cnpj_favorecido": lambda: digits_only("codigoPessoa")},
            write="replace",
            keys=("cnpj_favorecido", "_reference_year"),
        ),
        Source(
            "raw_siops.rreo_anexo14",
            BUDGET_FIELDS,
            types={
                "ano_exercicio": "int",
                "periodo_bimestre": "int",
                "id_municipio": "int",
                "populacao": "bigint",
                "valor": MONEY,
            },
            write="replace",
            keys=("id_municipio", "ano_exercicio", "periodo_bimestre"),
        ),
        Source(
            "raw_sisab.indicador_desempenho",
            {c: c for c in INDICATOR_FIELDS},
            types={
                "codigo_municipio": "int",
                "competencia": "int",
                "codigo_tipo_indicador": "int",
                "populacao": "bigint",
                **{
                    c: RATE
                    for c in (
                        "numerador",
                        "denominador_utilizador",
                        "denominador_identificado",
                        "denominador_estimado",
                        "percentual",
                        "percentual_quadrimestre",
                        "cadastro",
                        "base_externa",
                    )
                },
            },
            write="replace",
            keys=("codigo_municipio", "quadrimestre"),
        ),
        Source(
            "raw_sisab.cadastro_vinculado",
            {c: c for c in ENROLMENT_FIELDS},
            types={
                "competencia_referencia": "int",
                "codigo_municipio_ibge": "int",
                "estimativa_populacional_ibge": "bigint",
                "tipo_equipe": "int",
                "pessoas_vinculadas_equipe_municipio": RATE,
            },
            write="replace",
            keys=("codigo_municipio_ibge", "competencia_referencia"),
        ),
    )
}


def normalize(rows: DataFrame, table: str, scope: Mapping[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Validate, restrict to scope and rename one source.

    Columnar files are checked once by their columns. JSON records (see ``read_records``)
    are checked key by key, then opened. The scope filter runs first, as rows out of scope
    are never read further.
    """
    source = SOURCES[table]
    wanted = source.scope if scope is None else scope
    if "fields" in rows.columns and "record" in rows.columns:
        rows = require_fields(rows, list(source.fields), table)
        every = [*source.fields, *source.optional]
        rows = rows.select(
            *[F.col("fields")[name].alias(name) for name in every],
            *[c for c in (SOURCE_FILE, POSITION) if c in rows.columns],
        )
    else:
        require_columns(rows, list(source.fields), table)
    for name, values in wanted.items():
        rows = rows.filter(F.col(name).isin(*values))
    origin = [c for c in (SOURCE_FILE, POSITION) if c in rows.columns]
    return rows.select(*_columns(source, rows.columns), *origin)


def place_scope(table: str, codes: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """The scope of a source with its municipalities replaced by ``codes``."""
    declared = SOURCES[table].scope
    return {name: tuple(codes) if values == REFERENCE_CODES else values for name, values in declared.items()}


def _columns(source: Source, present: list[str]) -> list[Column]:
    made: dict[str, Column] = {}
    for name, column in {**source.fields, **source.optional}.items():
        if column in source.computed:
            made[column] = source.computed[column]()
        elif name in present:
            made[column] = F.col(name)
        else:
            made[column] = F.lit(None).cast("string")
    for column, kind in source.types.items():
        made[column] = made[column].cast(kind)
    return [c.alias(name) for name, c in made.items()]


TERRITORY_SCHEMA = """
    id int, nome string,
    microrregiao struct<id int, nome string,
        mesorregiao struct<id int, nome string,
            UF struct<id int, sigla string, nome string,
                regiao struct<id int, sigla string, nome string>>>>,
    `regiao-imediata` struct<id int, nome string,
        `regiao-intermediaria` struct<id int, nome string,
            UF struct<id int, sigla string, nome string,
                regiao struct<id int, sigla string, nome string>>>>
"""


def territory(records: DataFrame, keep_place: bool = False) -> DataFrame:
    """Municipality documents to flat rows. A municipality without a micro-region takes its
    state from the immediate region and has no micro and meso region. ``keep_place`` adds the
    file and the place in it, which a load needs to tell the last record of a key."""
    table = "raw_ibge.municipios"
    complete = require_fields(records, ["id", "nome"], table)
    # Reading ``fields`` keeps its check in the plan.
    whole = F.when(F.col("fields").isNotNull(), F.col("record"))
    origin = [c for c in (SOURCE_FILE, POSITION) if keep_place and c in records.columns]
    place = complete.select(F.from_json(whole, TERRITORY_SCHEMA).alias("p"), *origin).select("p.*", *origin)
    micro = F.col("microrregiao")
    state = F.when(micro.isNotNull(), micro["mesorregiao"]["UF"]).otherwise(
        F.col("`regiao-imediata`")["regiao-intermediaria"]["UF"]
    )
    paths = "microrregiao.mesorregiao.UF or regiao-imediata.regiao-intermediaria.UF"
    place = place.withColumn("state", must(state, f"{table}: {paths} unresolved"))
    state = F.col("state")
    region = must(state["regiao"], f"{table}: UF.regiao unresolved")
    return place.select(
        F.col("id").alias("id_municipio"),
        F.col("nome").alias("nome_municipio"),
        micro["id"].alias("id_microrregiao"),
        micro["nome"].alias("nome_microrregiao"),
        micro["mesorregiao"]["id"].alias("id_mesorregiao"),
        micro["mesorregiao"]["nome"].alias("nome_mesorregiao"),
        state["id"].alias("id_uf"),
        state["sigla"].alias("sigla_uf"),
        state["nome"].alias("nome_uf"),
        region["id"].alias("id_regiao"),
        region["sigla"].alias("sigla_regiao"),
        region["nome"].alias("nome_regiao"),
        *origin,
    )


POPULATION_SCHEMA = """
    array<struct<resultados array<struct<series array<struct<
        localidade struct<id string, nome string>, serie map<string,string>>>>>>>
"""


def population(documents: DataFrame, keep_place: bool = False) -> DataFrame:
    """Population documents (value) to one row per place: the first variable, its first
    result, and the first year of each series. ``keep_place`` adds the file (of documents that
    carry ``_source_file``) and the place in it, as for ``territory``."""
    table = "raw_ibge.populacao_estimada"
    body = F.from_json("value", " ".join(POPULATION_SCHEMA.split()))
    series = F.try_element_at(F.try_element_at(body, F.lit(1))["resultados"], F.lit(1))["series"]
    found = must(series, f"{table}: resultados[0].series unresolved")
    point = F.try_element_at(F.map_entries("s.serie"), F.lit(1))
    named = [SOURCE_FILE] if keep_place and SOURCE_FILE in documents.columns else []
    row = F.struct(F.lit(0).cast("long").alias("block"), F.col("at").cast("long").alias("row"))
    origin = [*named, *([row.alias(POSITION)] if keep_place else [])]
    places = documents.select(F.posexplode(found).alias("at", "s"), *named).select(
        *origin,
        must(F.col("s.localidade.id"), f"{table}: localidade.id unresolved").alias("id"),
        F.col("s.localidade.nome").alias("nome"),
        must(point, f"{table}: empty serie").alias("point"),
    )
    return places.select(
        F.col("id").cast("int").alias("id_municipio"),
        F.col("nome").alias("nome_municipio"),
        F.col("point.key").cast("int").alias("ano_referencia"),
        F.col("point.value").cast("bigint").alias("populacao_estimada"),
        *[c for c in places.columns if c in (SOURCE_FILE, POSITION)],
    )


def facility_counts(facilities: DataFrame) -> DataFrame:
    """Facilities per municipality and period, whole state, no scope filter. Grouping by the
    period keeps files of several periods apart."""
    require_columns(facilities, ["CODUFMUN", "COMPETEN"], "raw_cnes.rede_porte_municipio")
    return facilities.groupBy(
        F.col("CODUFMUN").alias("cod_municipio_ibge6"), F.col("COMPETEN").alias("competencia")
    ).agg(F.count("*").cast("int").alias("quantidade_estabelecimentos"))


def provenance(
    rows: DataFrame,
    source: Column | str | None = None,
    year: Column | int | None = None,
    month: Column | int | None = None,
    loaded_at: Column | None = None,
    source_column: str = SOURCE_FILE,
) -> DataFrame:
    """Stamp load time (UTC), origin and reference period. One load carries one load time."""
    stamps = {"_loaded_at": loaded_at if loaded_at is not None else F.current_timestamp()}
    if source is not None:
        stamps[source_column] = F.lit(source) if isinstance(source, str) else source
    if year is not None:
        stamps["_reference_year"] = F.lit(year) if isinstance(year, int) else year
    if month is not None:
        stamps["_reference_month"] = F.lit(month) if isinstance(month, int) else month
    return rows.withColumns(stamps)
