"""One valid record per source, and small raw tables with defaults for every column."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from municare.sources import landing, raw

LOADED_AT = dt.datetime(2025, 1, 10, 12)

FACILITY = dict(
    CNES="0101010", CODUFMUN="330455", PF_PJ="3", NIV_DEP="1", TP_UNID="02", NATUREZA="",
    NAT_JUR="1031", ATIVIDAD="04", VINC_SUS="1", TPGESTAO="M", ESFERA_A="M", COMPETEN="202501",
    DT_ATUAL="202501",
)
TEAM = dict(
    IDEQUIPE="77", CNES="0101010", CODUFMUN="330455", TIPO_EQP="70", NOME_EQP="EQUIPE A",
    DT_ATIVA="202001", DT_DESAT="900001", MOTDESAT="00", TP_DESAT="0", COMPETEN="202512",
    ID_AREA="1", NOMEAREA="AREA", ID_SEGM="2", DESCSEGM="SEG", TIPOSEGM="1",
)
PRODUCTION = dict(
    PA_CODUNI="0101010", PA_UFMUN="330455", PA_MUNPCN="330380", PA_CMP="202501",
    PA_PROC_ID="0301010010", PA_CBOCOD="225125", PA_CATEND="01", PA_IDADE="045", PA_SEXO="F",
    PA_RACACOR="01", PA_QTDPRO="3", PA_QTDAPR="2", PA_VALPRO="10.50", PA_VALAPR="7.00",
    PA_DOCORIG="I",
)
ADMISSION = dict(
    N_AIH="9001", CNES="0101010", MUNIC_MOV="330455", MUNIC_RES="330380", ANO_CMPT="2025",
    MES_CMPT="3", PROC_REA="0303010010", CBOR="225125", IDADE="70", SEXO="1", RACA_COR="01",
    DIAG_PRINC="J158", VAL_TOT="812.40", DT_INTER="20250227", DT_SAIDA="20250302",
    DIAS_PERM="3", MORTE="0",
)
DEATH = dict(
    ORIGEM="1", CODESTAB="0101010", CODMUNOCOR="330455", CODMUNRES="330350", DTOBITO="29022024",
    DTNASC="01011950", IDADE="474", SEXO="1", RACACOR="1", ESTCIV="2", ESC="4", LOCOCOR="1",
    CAUSABAS="I219", CIRCOBITO="9", ASSISTMED="1",
)
BIRTH = dict(
    ORIGEM="1", CODESTAB="0101010", CODMUNNASC="330455", CODMUNRES="330350", DTNASC="05042022",
    SEXO="2", RACACOR="1", PESO="3100", GESTACAO="5", PARTO="1", APGAR1="9", APGAR5="",
    CONSULTAS="7", IDADEMAE="31", ESCMAE="4",
)
FUND = dict(
    id_lancamento_gestao_financeira=11,
    cnpj_ente_solicitante_gestao_financeira="42498733000148",
    nome_ente_solicitante_gestao_financeira="ENTE",
    tipo_operacao_gestao_financeira="C",
    descricao_tipo_operacao_gestao_financeira="Entrada",
    descricao_gestao_financeira="Deposito",
    data_lancamento_gestao_financeira="2025-03-04",
    data_evento_lancamento_gestao_financeira="2025-03-05",
    valor_lancamento_gestao_financeira=120.75,
    tipo_favorecido_gestao_financeira=2,
)
RECEIPT = dict(
    anoMes=202503, codigoPessoa="29.172.475/0001-47", nomePessoa="ENTE B", tipoPessoa="T",
    municipioPessoa="M", siglaUFPessoa="RJ", codigoUG="1", nomeUG="UNIDADE", codigoOrgao="2",
    nomeOrgao="ORGAO", codigoOrgaoSuperior="3", nomeOrgaoSuperior="SUPERIOR", valor=-80.25,
)
BUDGET = dict(
    exercicio=2025, demonstrativo="RREO", periodo=6, periodicidade="B", instituicao="P",
    cod_ibge=3304557, uf="RJ", populacao=1000, anexo="A", esfera="M", rotulo="R",
    coluna="C", cod_conta="K", conta="CONTA", valor=12.5,
)
INDICATOR = dict(
    uf="RJ", municipio="M", codigo_municipio=330455, quadrimestre="2024Q3", competencia=202412,
    codigo_tipo_indicador=40, visao_equipe="v", numerador=10.0, denominador_utilizador=20.0,
    denominador_identificado=15.0, denominador_estimado=20.0, percentual=50,
    percentual_quadrimestre=50.0, cadastro=100.0, base_externa=5, populacao=900,
)
ENROLMENT = dict(
    competencia_referencia=202412, sigla_unidade_federacao="RJ", codigo_municipio_ibge=330455,
    nome_municipio="M", estimativa_populacional_ibge=1000, tipo_equipe=70, sigla_equipe="eSF",
    situacao_equipe="homologadas", pessoas_vinculadas_criterios_ponderacao="Não",
    pessoas_vinculadas_equipe_municipio=400.0,
)
DETAIL = dict(codigo_cnes=101010, nome_fantasia="POSTO", endereco_estabelecimento="RUA",
              estabelecimento_possui_centro_cirurgico=1)


def place(number, name, state, region, lower=True):
    uf = {"id": state, "sigla": "RJ", "nome": "Rio", "regiao": {"id": region, "sigla": "SE", "nome": "Sudeste"}}
    record = {"id": number, "nome": name, "microrregiao": None}
    if lower:
        record["microrregiao"] = {"id": 5, "nome": "Mi", "mesorregiao": {"id": 6, "nome": "Me", "UF": uf}}
    else:
        record["regiao-imediata"] = {"id": 1, "regiao-intermediaria": {"id": 2, "UF": uf}}
    return record


def population(*places):
    """(id, name, {year: number}) each."""
    series = [{"localidade": {"id": i, "nome": n}, "serie": s} for i, n, s in places]
    return [{"id": "1", "resultados": [{"series": series}]}]


def text(spark, documents, name="f.json"):
    rows = [(json.dumps(d, ensure_ascii=False), name) for d in documents]
    return spark.createDataFrame(rows, "value string, _source_file string")


def records(spark, documents, layout="lines", envelope=None):
    return landing.records_from_text(text(spark, documents), layout, envelope)


def lines(spark, *rows):
    """Landed columnar rows, every field text."""
    names = list(rows[0])
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} string" for n in names))


def stamped(rows, year=2025, month=12, url=False):
    rows = rows.drop("_source_file")
    at = F.lit(LOADED_AT).cast("timestamp")
    return raw.provenance(rows, "origin", year, month, at, "_source_url" if url else "_source_file")


def raw_tables(spark, **over):
    """The fifteen raw tables from lists of records; a list not given holds the one above."""

    def columnar(table, key, default, **kw):
        return stamped(raw.normalize(lines(spark, *over.get(key, [default])), table), **kw)

    def json_table(table, key, default, **kw):
        return stamped(raw.normalize(records(spark, over.get(key, [default])), table), url=True, **kw)

    places = over.get("places", [place(3304557, "Rio", 33, 3), place(3303807, "Paraty", 33, 3),
                                 place(3303500, "Nova", 33, 3), place(3300100, "Angra", 33, 3, False)])
    people = over.get("people", population(("3304557", "Rio", {"2025": "1000"}), ("3303807", "Paraty", {"2025": "0"}),
                                           ("3300100", "Angra", {"2025": "500"})))
    production = stamped(columnar("raw_sia.producao_ambulatorial", "production", PRODUCTION))
    return {
        "raw_ibge.municipios": stamped(raw.territory(records(spark, places)), url=True),
        "raw_ibge.populacao_estimada": stamped(raw.population(text(spark, [people])), url=True),
        "raw_cnes.estabelecimentos": columnar("raw_cnes.estabelecimentos", "facilities", FACILITY),
        "raw_cnes.equipes_aps": columnar("raw_cnes.equipes_aps", "teams", TEAM),
        "raw_cnes.estabelecimentos_detalhados": json_table(
            "raw_cnes.estabelecimentos_detalhados", "details", DETAIL
        ),
        "raw_cnes.rede_porte_municipio": stamped(
            raw.facility_counts(lines(spark, *over.get("network", [FACILITY])))
        ),
        "raw_sia.producao_ambulatorial": production.withColumn(
            "competencia_arquivo", F.lit(over.get("arrival", "202502"))
        ),
        "raw_sih.internacoes": columnar("raw_sih.internacoes", "admissions", ADMISSION),
        "raw_sim.obitos": columnar("raw_sim.obitos", "deaths", DEATH, year=2024),
        "raw_sinasc.nascidos_vivos": columnar("raw_sinasc.nascidos_vivos", "births", BIRTH, year=2022),
        "raw_fns.repasses": json_table("raw_fns.repasses", "fund", FUND),
        "raw_portaltransparencia.recursos_recebidos_saude": json_table(
            "raw_portaltransparencia.recursos_recebidos_saude", "receipts", RECEIPT
        ),
        "raw_siops.rreo_anexo14": json_table("raw_siops.rreo_anexo14", "budget", BUDGET),
        "raw_sisab.indicador_desempenho": json_table(
            "raw_sisab.indicador_desempenho", "indicators", INDICATOR
        ),
        "raw_sisab.cadastro_vinculado": json_table("raw_sisab.cadastro_vinculado", "enrolment", ENROLMENT),
    }
