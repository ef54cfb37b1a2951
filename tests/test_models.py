import datetime as dt
from decimal import Decimal as D

import pytest
import records as rec
from pyspark.sql import functions as F

from municare import storage
from municare.plans import CHECKS, MODELS, Workspace, build_marts, build_order, check_marts, open_marts
from municare.plans import marts, staging

RIO, PARATY, ANGRA = 3304557, 3303807, 3300100


def space(spark, **over):
    return Workspace(spark, rec.raw_tables(spark, **over))


def test_thirty_four_models_in_reading_order():
    order = build_order()
    assert len(order) == 34
    layers = [MODELS[n].layer for n in order]
    assert {x: layers.count(x) for x in set(layers)} == {"staging": 15, "intermediate": 2, "marts": 17}
    seen = set()
    for name in order:
        assert all(r in seen for r in MODELS[name].reads if r in MODELS)
        seen.add(name)
    assert len(CHECKS) == 153


def test_territory_and_bridge(spark):
    s = space(spark)
    assert s["dim_municipio"].count() == 4
    assert "_loaded_at" not in s["dim_municipio"].columns
    got = {r.id_municipio: r.cod_municipio_ibge6 for r in s["int_ibge__municipio_codigo6"].collect()}
    assert got == {RIO: "330455", PARATY: "330380", 3303500: "330350", ANGRA: "330010"}


def test_facility_codes(spark):
    odd = {**rec.FACILITY, "CNES": "2", "PF_PJ": "9", "NIV_DEP": "9", "TP_UNID": "85", "NATUREZA": "X",
           "NAT_JUR": "4000", "ATIVIDAD": "99", "VINC_SUS": "M", "TPGESTAO": "Z"}
    rows = {r.codigo_cnes: r for r in space(spark, facilities=[rec.FACILITY, odd])["stg_cnes__estabelecimentos"].collect()}
    a, b = rows["0101010"], rows["2"]
    assert (a.id_estabelecimento_competencia, a.competencia_date) == ("0101010-202501", dt.date(2025, 1, 1))
    assert (a.tipo_pessoa, a.nivel_dependencia, a.atividade_ensino, a.tipo_gestao) == (
        "juridica", "individual", "sem_atividade_de_ensino", "municipal",
    )
    assert a.descricao_tipo_unidade == "Centro de Saúde/Unidade Básica de Saúde"
    assert a.descricao_natureza_juridica == "Órgão Público do Poder Executivo Municipal"
    assert a.natureza_organizacao is None and a.tem_vinculo_sus is True
    assert (b.tipo_pessoa, b.nivel_dependencia, b.descricao_tipo_unidade, b.descricao_natureza_juridica) == (None,) * 4
    assert (b.atividade_ensino, b.tipo_gestao, b.tem_vinculo_sus) == ("nao_informado", "nao_informado", None)


def months(cnes, *periods, **changes):
    return [{**rec.FACILITY, "CNES": cnes, "COMPETEN": p, **changes} for p in periods]


NETWORK = [
    *months("always", "202501", "202502", "202503"),
    *months("stopped", "202501", "202502", TP_UNID="05"),
    *months("late", "202503", CODUFMUN="330380"),
]


def test_network_history(spark):
    rows = space(spark, facilities=NETWORK)["mart_historico_rede_cnes"].collect()
    got = {(r.codigo_cnes, r.competencia_cadastro.month): r.situacao_operacional for r in rows}
    assert got == {
        ("always", 1): "historico", ("always", 2): "historico", ("always", 3): "ativo",
        ("stopped", 1): "historico", ("stopped", 2): "possivelmente_encerrado",
        ("late", 3): "ativo",
    }
    late = [r for r in rows if r.codigo_cnes == "late"][0]
    assert (late.id_municipio, late.primeira_competencia_observada) == (PARATY, dt.date(2025, 3, 1))


def test_facility_dimension_keeps_closed_facilities_at_their_last_state(spark):
    s = space(spark, facilities=NETWORK, details=[{**rec.DETAIL, "codigo_cnes": "stopped"}])
    rows = {r.codigo_cnes: r for r in s["dim_estabelecimento"].collect()}
    assert {k: r.competencia_cadastro.month for k, r in rows.items()} == {"always": 3, "stopped": 2, "late": 3}
    assert (rows["stopped"].nome_fantasia, rows["stopped"].possui_centro_cirurgico) == ("POSTO", True)
    assert rows["always"].nome_fantasia is None and rows["always"].possui_centro_cirurgico is None


def test_teams(spark):
    teams = [rec.TEAM, {**rec.TEAM, "IDEQUIPE": "78", "TIPO_EQP": "76", "DT_DESAT": "202306", "CNES": "none"},
             {**rec.TEAM, "IDEQUIPE": "79", "TIPO_EQP": "71"}]
    rows = {r.id_equipe: r for r in space(spark, teams=teams)["mart_equipe_aps_detalhada"].collect()}
    assert set(rows) == {"77", "78"}
    assert (rows["77"].sigla_equipe, rows["77"].situacao_equipe, rows["77"].nome_unidade) == ("eSF", "ativa", "POSTO")
    assert (rows["78"].sigla_equipe, rows["78"].situacao_equipe, rows["78"].nome_unidade) == ("eAP", "desativada", None)
    assert rows["78"].nome_municipio == "Rio"


def test_production_fact_and_group_mart(spark):
    p = rec.PRODUCTION
    lines = [p, {**p, "PA_IDADE": "999"}, {**p, "PA_PROC_ID": "1001010010"}, {**p, "PA_UFMUN": "999999"}]
    s = space(spark, production=lines)
    facts = s["fct_producao_ambulatorial"]
    assert facts.filter("idade_paciente is null").count() == 1
    assert {(r[0], r[1]) for r in facts.select("id_municipio_estabelecimento", "id_municipio_paciente").collect()} == {
        (RIO, PARATY), (None, PARATY),
    }
    assert facts.filter("competencia_arquivo = '202502' and competencia_date = date '2025-01-01'").count() == 4
    got = {r.codigo_grupo: r for r in s["mart_producao_grupo_municipio"].collect()}
    assert set(got) == {"03", "10"}
    assert (got["03"].descricao_grupo, got["10"].descricao_grupo) == ("Procedimentos clínicos", None)
    assert (got["03"].quantidade_registros, got["03"].quantidade_produzida, got["03"].valor_aprovado) == (2, 6, D("14.00"))


def test_strict_and_tolerant_production(spark):
    bad = {**rec.PRODUCTION, "PA_QTDPRO": "", "PA_CMP": "202513"}
    s = space(spark, production=[rec.PRODUCTION])
    raw = s["raw_sia.producao_ambulatorial"]
    broken = raw.unionByName(
        raw.withColumns({"quantidade_produzida": F.lit(bad["PA_QTDPRO"]), "competencia": F.lit(bad["PA_CMP"])})
    )
    with pytest.raises(Exception):
        staging.production(broken).collect()
    tolerant = staging.production(broken, strict=False)
    assert tolerant.filter("quantidade_produzida is null and competencia_date is null").count() == 1
    lost = {r.column: r.unreadable for r in staging.quarantine(broken, "raw_sia.producao_ambulatorial").collect()}
    assert lost["quantidade_produzida"] == 1 and lost["competencia"] == 1 and lost["valor_produzido"] == 0


def test_sensitive_admissions(spark):
    a = rec.ADMISSION
    admissions = [
        {**a, "N_AIH": "1", "DIAG_PRINC": "J158"},
        {**a, "N_AIH": "2", "DIAG_PRINC": "I20"},
        {**a, "N_AIH": "3", "DIAG_PRINC": "J15"},
        {**a, "N_AIH": "4", "DIAG_PRINC": "A379"},
        {**a, "N_AIH": "5", "DIAG_PRINC": "G000"},
        {**a, "N_AIH": "6", "DIAG_PRINC": "O800", "DT_INTER": "20241231"},
        {**a, "N_AIH": "7", "DIAG_PRINC": "I20", "MUNIC_RES": "999999"},
    ]
    s = space(spark, admissions=admissions)
    codes = {r.diagnostico_principal: (r.grupo_icsap, r.is_icsap) for r in s["int_sih__diagnostico_icsap"].collect()}
    assert codes["I20"][1] and codes["A379"] == (1, True) and codes["G000"] == (1, True)
    assert codes["O800"] == (None, False)
    got = {(r.id_municipio, r.ano): r for r in s["mart_icsap_municipio"].collect()}
    assert set(got) == {(PARATY, 2025), (PARATY, 2024)}
    hits = sum(codes[a["DIAG_PRINC"]][1] for a in admissions[:5])
    row = got[(PARATY, 2025)]
    assert (row.total_internacoes, row.total_internacoes_icsap) == (5, hits)
    assert row.percentual_icsap == D(100 * hits) / D(5)
    assert got[(PARATY, 2024)].percentual_icsap == 0
    assert s["fct_internacoes"].filter("id_municipio_paciente is null").count() == 1


def test_deaths_and_births(spark):
    ages = ["000", "999", "464", "500", "215", "315", "115", "015"]
    s = space(spark, deaths=[{**rec.DEATH, "IDADE": a, "CAUSABAS": a} for a in ages])
    got = {r.causa_basica: (r.idade_unidade, r.idade_valor) for r in s["fct_obitos"].collect()}
    assert got == {
        "000": ("nao_informado", None), "999": ("nao_informado", None), "464": ("anos", 64),
        "500": ("anos_mais_de_100", 0), "215": ("dias", 15), "315": ("meses", 15),
        "115": ("horas", 15), "015": ("minutos", 15),
    }
    assert s["fct_obitos"].first().data_obito == dt.date(2024, 2, 29)
    birth = s["fct_nascidos_vivos"].first()
    assert (birth.apgar1, birth.apgar5, birth.peso_gramas, birth.id_municipio_residencia) == (9, None, 3100, 3303500)
    raw = s["raw_sim.obitos"].withColumn("data_obito", F.lit("30022024"))
    with pytest.raises(Exception):
        staging.deaths(raw).collect()
    assert staging.deaths(raw, strict=False).first().data_obito is None
    lost = {r.column: r.unreadable for r in staging.quarantine(raw, "raw_sim.obitos").collect()}
    assert lost == {"data_obito": 8, "data_nascimento": 0, "idade": 0}


def test_funding_signs(spark):
    f, r = rec.FUND, rec.RECEIPT
    fund = [{**f, "id_lancamento_gestao_financeira": i, "tipo_operacao_gestao_financeira": k,
             "cnpj_ente_solicitante_gestao_financeira": c}
            for i, k, c in ((1, "C", "42498733000148"), (2, "D", "42498733000148"), (3, "X", "0"))]
    receipts = [r, {**r, "valor": 0}, {**r, "valor": 5.5, "codigoPessoa": "1"}]
    s = space(spark, fund=fund, receipts=receipts)
    got = sorted(
        ((x.fonte, x.id_municipio, x.tipo_lancamento, x.valor, x.ano) for x in s["mart_financiamento_saude_uniao"].collect()),
        key=str,
    )
    assert got == sorted(
        [
            ("fns_fundo_a_fundo", RIO, "credito", D("120.75"), 2025),
            ("fns_fundo_a_fundo", RIO, "debito", D("-120.75"), 2025),
            ("fns_fundo_a_fundo", None, None, D("120.75"), 2025),
            ("portal_transparencia", PARATY, "estorno", D("-80.25"), 2025),
            ("portal_transparencia", PARATY, "recurso", D("0.00"), 2025),
            ("portal_transparencia", None, "recurso", D("5.50"), 2025),
        ],
        key=str,
    )
    assert {(x.id_lancamento, x.ano, x.valor_lancamento) for x in s["mart_repasses_fns"].collect()} == {
        (1, 2025, D("120.75")), (2, 2025, D("120.75")), (3, 2025, D("120.75")),
    }


def test_indicator_bands(spark):
    i = rec.INDICATOR
    cases = [("edge", 80, 40), ("target", 40, 40), ("below", 39.5, 40), ("none", None, 40), ("unknown", 99, 90)]
    s = space(spark, indicators=[
        {**i, "visao_equipe": n, "percentual_quadrimestre": v, "codigo_tipo_indicador": k} for n, v, k in cases
    ])
    got = {r.visao_equipe: (r.numero_indicador, r.status_meta) for r in s["mart_indicadores_aps"].collect()}
    assert got == {
        "edge": (4, "ok"), "target": (4, "atencao"), "below": (4, "critico"), "none": (4, None),
        "unknown": (None, "critico"),
    }


def test_coverage(spark):
    e = rec.ENROLMENT
    enrolment = [
        e,
        {**e, "situacao_equipe": "todas"},
        {**e, "situacao_equipe": "válidas"},
        {**e, "pessoas_vinculadas_criterios_ponderacao": "Sim"},
        {**e, "pessoas_vinculadas_criterios_ponderacao": "Outro"},
        {**e, "sigla_equipe": "eAP"},
        {**e, "codigo_municipio_ibge": 330380},
    ]
    teams = [rec.TEAM, {**rec.TEAM, "IDEQUIPE": "2", "TIPO_EQP": "76"},
             {**rec.TEAM, "IDEQUIPE": "3", "DT_DESAT": "202301"}]
    got = {r.id_municipio: r for r in space(spark, enrolment=enrolment, teams=teams)["mart_cobertura_aps_municipio"].collect()}
    assert set(got) == {RIO, PARATY}
    rio, paraty = got[RIO], got[PARATY]
    assert (rio.quantidade_equipes_esf_ativas, rio.quantidade_equipes_aps_ativas_total) == (1, 2)
    assert (rio.populacao_vinculada_esf_homologada, rio.percentual_cobertura_esf) == (400, D("40.0"))
    assert (paraty.quantidade_equipes_esf_ativas, paraty.competencia_equipes_cnes) == (0, None)
    assert paraty.populacao_vinculada_esf_homologada == 400 and paraty.percentual_cobertura_esf is None


def test_peers(spark):
    got = {r.id_municipio: r for r in space(spark, network=[rec.FACILITY] * 3)["mart_comparacao_municipios_rj"].collect()}
    assert set(got) == {RIO, PARATY, ANGRA}
    assert got[RIO].estabelecimentos_por_10k_habitantes == D("30.00")
    assert got[ANGRA].quantidade_estabelecimentos_saude is None
    assert {k: r.municipio_referencia for k, r in got.items()} == {RIO: True, PARATY: True, ANGRA: False}


def test_alerts(spark):
    b = {**rec.BUDGET, "conta": marts.SPENDING_ACCOUNT}

    def pair(place, applied, minimum):
        yield {**b, "cod_ibge": place, "coluna": marts.SPENDING_APPLIED, "valor": applied}
        if minimum is not None:
            yield {**b, "cod_ibge": place, "coluna": marts.SPENDING_MINIMUM, "valor": minimum}

    budget = [*pair(RIO, 14.5, 15), *pair(PARATY, 15, 15), *pair(3303500, 16.2, 15), *pair(ANGRA, 1, None)]
    s = space(spark, budget=budget, facilities=NETWORK)
    got = {r.codigo_regra: r for r in s["mart_alertas_saude"].collect()}
    assert s["mart_alertas_saude"].count() == 3
    spending = got["siops_abaixo_minimo_constitucional"]
    assert (spending.id_municipio, spending.periodo_referencia, spending.severidade) == (RIO, "2025-B6", "alta")
    assert spending.evidencia == "Aplicado 14.50% no exercício, abaixo do mínimo de 15.00%"
    closure = got["rede_cnes_possivel_encerramento"]
    assert (closure.id_municipio, closure.evidencia[:20]) == (RIO, "1 estabelecimento(s)")
    balance = got["financiamento_liquido_negativo"]
    assert (balance.id_municipio, balance.evidencia) == (PARATY, "Saldo líquido de R$ -80.25 em 2025")
    assert balance.nome_municipio == "Paraty" and balance.status == "ativo"


def test_build_checks_and_second_run(spark, folder):
    raw = rec.raw_tables(spark, facilities=NETWORK)
    built = build_marts(spark, raw, folder)
    assert spark.table("stg_sih__internacoes").count() == 1
    assert storage.names(spark, f"{folder}/marts") == sorted(n for n in MODELS if MODELS[n].layer == "marts")
    results = check_marts(open_marts(spark, raw, folder), folder)
    assert results.count() == 153
    assert storage.exists(spark, f"{folder}/quality/dq_results")
    assert {(r.model, r.column): r.severity for r in results.filter("failures > 0").collect()} == {
        ("fct_producao_ambulatorial", "codigo_cnes_estabelecimento"): "warn",
        ("fct_internacoes", "codigo_cnes_estabelecimento"): "warn",
    }
    some = ["mart_alertas_saude", "fct_producao_ambulatorial"]
    before = {n: built[n].count() for n in some}
    again = build_marts(spark, raw, folder, names=some)
    assert {n: again[n].count() for n in some} == before


def test_production_backfill_by_period(spark, folder):
    first = rec.raw_tables(spark, arrival="202501")
    second = rec.raw_tables(spark, arrival="202502")
    name = "raw_sia.producao_ambulatorial"
    raw = {**first, name: first[name].unionByName(second[name])}
    fact = "fct_producao_ambulatorial"
    one = build_marts(spark, raw, folder, bootstrap_period="202502", names=[fact])
    assert [r.competencia_arquivo for r in one[fact].collect()] == ["202502"]
    both = build_marts(spark, raw, folder, names=[fact])
    assert sorted(r.competencia_arquivo for r in both[fact].collect()) == ["202501", "202502"]
