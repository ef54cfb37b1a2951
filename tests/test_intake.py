import json

import pytest
import records as rec

from municare import storage
from municare.intake import ingest_file, ingest_json, open_raw
from municare.plans import build_marts
from municare.schemas import RAW_SCHEMAS, raw_schema
from municare.sources.validate import EmptySource, PageLimitReached

BIMESTER = {"id_municipio": 3304557, "ano_exercicio": 2025, "periodo_bimestre": 6}
PLACE = {"codigo_municipio": 330455, "quadrimestre": "2024Q3"}


def land(spark, folder, name, *rows):
    rec.lines(spark, *rows).coalesce(1).write.parquet(f"{folder}/{name}.tmp")
    part = [n for n in storage.names(spark, f"{folder}/{name}.tmp") if n.endswith(".parquet")][0]
    storage.rename(spark, f"{folder}/{name}.tmp/{part}", f"{folder}/{name}.parquet")


def answer(spark, path, body):
    spark.createDataFrame([(json.dumps(body),)], "value string").coalesce(1).write.text(path)


def test_declared_columns_fit_what_is_made(spark):
    made = rec.raw_tables(spark)
    assert set(made) == set(RAW_SCHEMAS)
    for name, rows in made.items():
        declared = {f.name: f.dataType for f in raw_schema(name)}
        assert {f.name: f.dataType for f in rows.schema if f.name in declared} == declared, name


def test_files_answers_and_marts_end_to_end(spark, folder):
    landing, root = f"{folder}/landing", f"{folder}/lake"
    p = rec.PRODUCTION
    land(spark, landing, "PARJ2501a", p, p)
    land(spark, landing, "PARJ2501b", p)
    land(spark, landing, "PARJ2502", {**p, "PA_CMP": "202502"}, {**p, "PA_CMP": "202501"})
    land(spark, landing, "STRJ2501", rec.FACILITY, {**rec.FACILITY, "CNES": "2", "CODUFMUN": "330010"})
    land(spark, landing, "EPRJ2512", rec.TEAM)
    land(spark, landing, "RDRJ2503", rec.ADMISSION)
    land(spark, landing, "RDRJ2504", {**rec.ADMISSION, "VAL_TOT": "1.00"}, {**rec.ADMISSION, "N_AIH": "2"})
    land(spark, landing, "DORJ2024", rec.DEATH, {**rec.DEATH, "CODMUNOCOR": "330010"})
    land(spark, landing, "DNRJ2022", rec.BIRTH)

    def load_files():
        def one(table, year, month=None):
            ingest_file(spark, landing, root, table, "rj", year, month)

        for month in (1, 2):
            one("raw_sia.producao_ambulatorial", 2025, month)
        for month in (3, 4):
            one("raw_sih.internacoes", 2025, month)
        one("raw_cnes.estabelecimentos", 2025, 1)
        one("raw_cnes.rede_porte_municipio", 2025, 1)
        one("raw_cnes.equipes_aps", 2025, 12)
        one("raw_sim.obitos", 2024)
        one("raw_sinasc.nascidos_vivos", 2022)

    answers = {
        "raw_ibge.municipios": ([rec.place(3304557, "Rio", 33, 3), rec.place(3303807, "Paraty", 33, 3),
                                 rec.place(3303500, "Nova", 33, 3), rec.place(3300100, "Angra", 33, 3, False)], None),
        "raw_ibge.populacao_estimada": (rec.population(("3304557", "Rio", {"2025": "1000"})), None),
        "raw_cnes.estabelecimentos_detalhados": ({"estabelecimentos": [rec.DETAIL]}, None),
        "raw_fns.repasses": ([rec.FUND], None),
        "raw_portaltransparencia.recursos_recebidos_saude": (
            [rec.RECEIPT], [{"cnpj_favorecido": "29172475000147", "_reference_year": 2025}]),
        "raw_siops.rreo_anexo14": (
            {"items": [rec.BUDGET]}, [{"id_municipio": 3304557, "ano_exercicio": 2025, "periodo_bimestre": 6}]),
        "raw_sisab.indicador_desempenho": ({"sisab_indicador_desempenho": [rec.INDICATOR]}, [PLACE]),
        "raw_sisab.cadastro_vinculado": (
            {"sisab_cadastro_vinculado": [rec.ENROLMENT]},
            [{"codigo_municipio_ibge": 330455, "competencia_referencia": 202412}]),
    }
    for table, (body, _) in answers.items():
        answer(spark, f"{landing}/{table}", body)

    def load_answers():
        for table, (_, partitions) in answers.items():
            ingest_json(spark, f"{landing}/{table}", root, table, "https://x", 2025 if "fns" in table or "portal" in table else None, partitions)

    load_files()
    load_answers()
    counts = {name: rows.count() for name, rows in open_raw(spark, root).items()}
    assert counts["raw_sia.producao_ambulatorial"] == 5
    assert counts["raw_sih.internacoes"] == 2
    assert counts["raw_cnes.estabelecimentos"] == 1 and counts["raw_cnes.rede_porte_municipio"] == 2
    assert counts["raw_sim.obitos"] == 1 and counts["raw_ibge.municipios"] == 4
    assert all(counts.values())
    load_files()
    raw = open_raw(spark, root)
    assert {name: rows.count() for name, rows in raw.items()} == counts
    won = raw["raw_sih.internacoes"].filter("numero_aih = '9001'").first()
    assert (won.valor_total, won._source_file) == ("1.00", "RDRJ2504.parquet")
    assert {r._source_file for r in raw["raw_sia.producao_ambulatorial"].collect()} == {
        "PARJ2501a.parquet", "PARJ2501b.parquet", "PARJ2502.parquet",
    }
    wanted = ["mart_producao_grupo_municipio", "mart_cobertura_aps_municipio"]
    marts = build_marts(spark, raw, root, names=wanted)
    assert marts["mart_producao_grupo_municipio"].agg({"quantidade_registros": "sum"}).first()[0] == 5
    assert marts["mart_cobertura_aps_municipio"].first().quantidade_equipes_esf_ativas == 1


def test_guards(spark, folder):
    with pytest.raises(EmptySource, match="PARJ2501"):
        ingest_file(spark, folder, folder, "raw_sia.producao_ambulatorial", "rj", 2025, 1)
    answer(spark, f"{folder}/none", {"items": []})
    with pytest.raises(EmptySource, match="rreo"):
        ingest_json(spark, f"{folder}/none", folder, "raw_siops.rreo_anexo14", "https://x", None, [BIMESTER])
    answer(spark, f"{folder}/full", {"sisab_indicador_desempenho": [rec.INDICATOR] * 1000})
    with pytest.raises(PageLimitReached, match="1000"):
        ingest_json(spark, f"{folder}/full", folder, "raw_sisab.indicador_desempenho", "https://x", None, [PLACE])
    answer(spark, f"{folder}/one", {"items": [rec.BUDGET]})
    with pytest.raises(ValueError, match="name the partitions"):
        ingest_json(spark, f"{folder}/one", folder, "raw_siops.rreo_anexo14", "https://x")


def test_one_empty_answer_stops_the_load_and_keeps_what_is_stored(spark, folder):
    asked = [{"id_municipio": m, "ano_exercicio": 2025, "periodo_bimestre": 6} for m in (3304557, 3303807)]
    table, root = "raw_siops.rreo_anexo14", f"{folder}/lake"
    budgets = [{**rec.BUDGET}, {**rec.BUDGET}]
    for name, rows in (("both", budgets), ("one", [budgets[0]])):
        answer(spark, f"{folder}/{name}/a", {"items": rows})
    ingest_json(spark, f"{folder}/both/a", root, table, "https://x", None, asked[:1])
    answer(spark, f"{folder}/one/b", {"items": []})
    with pytest.raises(EmptySource, match="holds no records"):
        ingest_json(spark, f"{folder}/one/*", root, table, "https://x", None, asked)
    assert open_raw(spark, root)[table].count() == 2


def test_scope_missing_tables_and_missing_values(spark, folder):
    from municare.sinks.tables import MissingTable

    root, table = f"{folder}/lake", "raw_sih.internacoes"
    place = {**rec.ADMISSION, "MUNIC_MOV": "100005"}
    land(spark, folder, "RDRJ2503", rec.ADMISSION, {**place, "N_AIH": "7"}, {**place, "N_AIH": "8", "VAL_TOT": "2.00"})
    ingest_file(spark, folder, root, table, "rj", 2025, 3, scope=["100005"])
    raw = open_raw(spark, root)
    assert sorted(r.numero_aih for r in raw[table].collect()) == ["7", "8"]
    with pytest.raises(MissingTable):
        raw["raw_sim.obitos"]
    assert open_raw(spark, root, ["raw_sim.obitos"])["raw_sim.obitos"].count() == 0
    land(spark, folder, "RDRJ2504", {**rec.ADMISSION, "N_AIH": "9"}, {**rec.ADMISSION, "VAL_TOT": None})
    with pytest.raises(Exception, match="no value for valor_total"):
        ingest_file(spark, folder, root, table, "rj", 2025, 4)
    assert raw[table].count() == 2
