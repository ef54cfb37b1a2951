import datetime as dt
import json
from decimal import Decimal

import pytest
import records as rec
from pyspark.sql import functions as F

from municare import sources
from municare.sources import landing, raw
from municare.sources.lookups import SEED_SCHEMAS
from municare.sources.validate import EmptySource, MissingField, PageLimitReached

COLUMNAR = {
    "raw_cnes.estabelecimentos": rec.FACILITY,
    "raw_cnes.equipes_aps": rec.TEAM,
    "raw_sia.producao_ambulatorial": rec.PRODUCTION,
    "raw_sih.internacoes": rec.ADMISSION,
    "raw_sim.obitos": rec.DEATH,
    "raw_sinasc.nascidos_vivos": rec.BIRTH,
}
JSON = {
    "raw_fns.repasses": rec.FUND,
    "raw_portaltransparencia.recursos_recebidos_saude": rec.RECEIPT,
    "raw_siops.rreo_anexo14": rec.BUDGET,
    "raw_sisab.indicador_desempenho": rec.INDICATOR,
    "raw_sisab.cadastro_vinculado": rec.ENROLMENT,
    "raw_cnes.estabelecimentos_detalhados": rec.DETAIL,
}


@pytest.mark.parametrize("table", COLUMNAR)
def test_columnar_source_is_renamed(spark, table):
    record, source = COLUMNAR[table], raw.SOURCES[table]
    got = raw.normalize(rec.lines(spark, record), table).first().asDict()
    plain = {c: record[f] for f, c in source.fields.items() if c not in source.computed}
    assert {c: got[c] for c in plain} == plain
    assert set(got) == set(source.fields.values())


@pytest.mark.parametrize("table, field", [(t, f) for t in COLUMNAR for f in raw.SOURCES[t].fields])
def test_columnar_source_refuses_a_missing_field(spark, table, field):
    partial = {k: v for k, v in COLUMNAR[table].items() if k != field}
    with pytest.raises(MissingField, match=field):
        raw.normalize(rec.lines(spark, partial), table)


@pytest.mark.parametrize("table", JSON)
def test_json_source_refuses_any_missing_field_and_accepts_null(spark, table):
    record, required = JSON[table], raw.SOURCES[table].fields
    nulls = {**record, **{f: None for f in required}}
    assert raw.normalize(rec.records(spark, [record, nulls]), table).count() == 2
    partial = [{k: v for k, v in record.items() if k != field} for field in required]
    audited = sources.field_audit(rec.records(spark, [record, nulls, *partial]), list(required))
    assert {r.field: r.missing for r in audited.collect()} == dict.fromkeys(required, 1)
    for field, broken in list(zip(required, partial))[:: max(1, len(partial) - 1)]:
        with pytest.raises(Exception, match=field):
            raw.normalize(rec.records(spark, [record, broken]), table).collect()


def test_scope_filters(spark):
    def kept(table, record, **changes):
        return raw.normalize(rec.lines(spark, record, {**record, **changes}), table).count()

    assert kept("raw_cnes.estabelecimentos", rec.FACILITY, CODUFMUN="330010") == 1
    assert kept("raw_cnes.equipes_aps", rec.TEAM, TIPO_EQP="71") == 1
    assert kept("raw_cnes.equipes_aps", rec.TEAM, CODUFMUN="330010") == 1
    assert kept("raw_sih.internacoes", rec.ADMISSION, MUNIC_MOV="330010") == 1
    assert kept("raw_sih.internacoes", rec.ADMISSION, MUNIC_RES="330010") == 2
    assert kept("raw_sim.obitos", rec.DEATH, CODMUNOCOR="330010") == 1
    assert kept("raw_sim.obitos", rec.DEATH, CODMUNRES="330010") == 2
    assert kept("raw_sinasc.nascidos_vivos", rec.BIRTH, CODMUNNASC="330010") == 1
    assert kept("raw_sia.producao_ambulatorial", rec.PRODUCTION, PA_UFMUN="330010") == 2


def test_admission_period_has_two_month_digits(spark):
    rows = raw.normalize(
        rec.lines(spark, rec.ADMISSION, {**rec.ADMISSION, "MES_CMPT": "12"}), "raw_sih.internacoes"
    )
    assert sorted(r.competencia for r in rows.collect()) == ["202503", "202512"]


def test_json_types(spark):
    fund = raw.normalize(rec.records(spark, [rec.FUND]), "raw_fns.repasses").first()
    assert (fund.id_lancamento, fund.valor_lancamento, fund.data_lancamento) == (
        11, Decimal("120.75"), dt.date(2025, 3, 4),
    )
    assert fund.tipo_favorecido == 2 and fund.nome_favorecido is None
    receipt = raw.normalize(
        rec.records(spark, [rec.RECEIPT]), "raw_portaltransparencia.recursos_recebidos_saude"
    ).first()
    assert (receipt.cnpj_favorecido, receipt.valor) == ("29172475000147", Decimal("-80.25"))


def test_facility_detail_pads_and_fills_optional_fields(spark):
    table = "raw_cnes.estabelecimentos_detalhados"
    rows = raw.normalize(rec.records(spark, [rec.DETAIL, {"codigo_cnes": 12345678}]), table)
    got = {r.codigo_cnes: r for r in rows.collect()}
    assert set(got) == {"0101010", "12345678"}
    assert got["0101010"].possui_centro_cirurgico == 1
    assert got["12345678"].nome_fantasia is None and got["12345678"].latitude is None


def test_territory_paths(spark):
    documents = [rec.place(1, "A", 33, 3), rec.place(2, "B", 51, 5, lower=False)]
    got = {r.id_municipio: r for r in raw.territory(rec.records(spark, documents)).collect()}
    assert (got[1].id_microrregiao, got[1].nome_mesorregiao, got[1].id_uf) == (5, "Me", 33)
    assert (got[2].id_microrregiao, got[2].id_mesorregiao, got[2].id_uf, got[2].id_regiao) == (None, None, 51, 5)


def test_territory_refuses_broken_chains(spark):
    def load(document):
        return raw.territory(rec.records(spark, [document])).collect()

    with pytest.raises(Exception, match="regiao-imediata"):
        load({"id": 1, "nome": "A", "microrregiao": None})
    with pytest.raises(Exception, match="UF"):
        load({"id": 1, "nome": "A", "microrregiao": {"id": 2, "nome": "M", "mesorregiao": {"id": 3, "nome": "N"}}})
    for field in ("id", "nome"):
        document = rec.place(1, "A", 33, 3)
        del document[field]
        with pytest.raises(Exception, match=field):
            load(document)
    stateless = rec.place(1, "A", 33, 3)
    del stateless["microrregiao"]["mesorregiao"]["UF"]["regiao"]
    with pytest.raises(Exception, match="regiao"):
        load(stateless)


def test_population_takes_first_year_of_each_place(spark):
    document = rec.population(("3304557", "Rio", {"2025": "10", "2024": "9"}), ("3303807", "Paraty", {"2025": "4"}))
    got = raw.population(rec.text(spark, [document])).collect()
    assert sorted(map(tuple, got)) == [(3303807, "Paraty", 2025, 4), (3304557, "Rio", 2025, 10)]


def test_population_refuses_other_shapes(spark):
    for document, told in (([], "series"), ([{"id": "1"}], "series"), (rec.population(("1", "A", {})), "serie")):
        with pytest.raises(Exception, match=told):
            raw.population(rec.text(spark, [document])).collect()


def test_facility_counts(spark):
    rows = rec.lines(
        spark, rec.FACILITY, {**rec.FACILITY, "CNES": "2"}, {**rec.FACILITY, "CODUFMUN": "330010"}
    )
    got = raw.facility_counts(rows)
    assert sorted(map(tuple, got.collect())) == [("330010", "202501", 1), ("330455", "202501", 2)]
    assert raw.facility_counts(rows.limit(0)).count() == 0


def test_file_names():
    assert sources.monthly_prefix("PA", "rj", 2025, 3) == "PARJ2503"
    assert sources.annual_prefix("DO", "rj", 2024) == "DORJ2024"


def test_parts_are_found_sorted_read_together_and_tagged(spark, folder):
    one = rec.lines(spark, rec.PRODUCTION).coalesce(1)
    from municare import storage

    for name in ("PARJ2512b", "parj2512A", "PARJ2512", "PARJ2511a", "PARJ2512ab"):
        one.write.parquet(f"{folder}/{name}.dir")
        part = [n for n in storage.names(spark, f"{folder}/{name}.dir") if n.endswith(".parquet")][0]
        storage.rename(spark, f"{folder}/{name}.dir/{part}", f"{folder}/{name}.parquet")
    paths = sources.find_parts(spark, folder, "PARJ2512")
    assert [p.rsplit("/", 1)[1] for p in paths] == ["PARJ2512.parquet", "PARJ2512b.parquet", "parj2512A.parquet"]
    rows = raw.normalize(sources.read_parts(spark, paths), "raw_sia.producao_ambulatorial")
    assert sorted(r._source_file for r in rows.collect()) == ["PARJ2512.parquet", "PARJ2512b.parquet", "parj2512A.parquet"]
    with pytest.raises(EmptySource, match="PARJ2601"):
        sources.find_parts(spark, folder, "PARJ2601")


def test_a_part_may_be_a_folder_of_files(spark, folder):
    from municare.sources.landing import POSITION

    def made(i):
        return spark.range(i, i + 40).selectExpr("cast(id as string) as v")

    made(0).repartition(3).write.parquet(f"{folder}/PARJ2512a.parquet")
    made(100).repartition(2).write.parquet(f"{folder}/PARJ2512b.parquet")
    rows = sources.read_parts(spark, sources.find_parts(spark, folder, "PARJ2512"))
    told = rows.groupBy("_source_file").agg(F.count("*").alias("n"), F.countDistinct(POSITION).alias("places"), F.countDistinct(f"{POSITION}.file").alias("files"))
    assert sorted(map(tuple, told.collect())) == [("PARJ2512a.parquet", 40, 40, 3), ("PARJ2512b.parquet", 40, 40, 2)]


def test_landed_parts_are_written_by_many_tasks(spark, folder):
    from municare import storage
    from municare.catalog.intake import _landing

    names = ["PARJ2501a.parquet", "parj2501B.parquet"]
    landing = _landing(spark, spark.range(0, 4000, 1, 5).selectExpr("id as k"), *names)
    for name in names:
        assert sum(n.endswith(".parquet") for n in storage.names(spark, f"{landing}/{name}")) == 5
    one = _landing(spark, spark.range(1).selectExpr("id as k"), *names)  # a part without rows is one too
    paths = sources.find_parts(spark, one, "PARJ2501")
    assert len(paths) == 2 and [r.k for r in sources.read_parts(spark, paths).collect()] == [0]


def test_csv_parts_stay_text(spark, folder):
    rec.lines(spark, rec.PRODUCTION).coalesce(1).write.option("header", "true").csv(folder)
    rows = sources.read_parts(spark, [folder], "csv")
    assert rows.first().PA_PROC_ID == "0301010010"


@pytest.mark.parametrize("layout", ["lines", "array", "envelope"])
def test_record_layouts(spark, folder, layout):
    many = [rec.BUDGET, {**rec.BUDGET, "periodo": 5}]
    body = {
        "lines": "\n".join(json.dumps(r) for r in many) + "\n\n",
        "array": json.dumps(many, indent=1),
        "envelope": json.dumps({"items": many}, indent=1),
    }[layout]
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(folder)
    found = sources.read_records(spark, folder, layout, "items" if layout == "envelope" else None)
    got = raw.normalize(found, "raw_siops.rreo_anexo14").collect()
    assert sorted(r.periodo_bimestre for r in got) == [5, 6]


def test_envelope_without_its_key_is_refused(spark):
    with pytest.raises(Exception, match="without 'items'"):
        landing.records_from_text(rec.text(spark, [{"other": []}]), "envelope", "items").collect()


def test_empty_and_full_page_guards(spark):
    rows = rec.records(spark, [rec.FUND, rec.FUND])
    assert sources.require_rows(rows, "fund") is rows
    with pytest.raises(EmptySource, match="fund"):
        sources.require_rows(rows.limit(0), "fund")
    assert sources.reject_full_pages(rows, 3, "fund") is rows
    with pytest.raises(PageLimitReached, match="2"):
        sources.reject_full_pages(rows, 2, "fund")


def test_field_audit_counts(spark):
    rows = rec.records(spark, [{"a": 1}, {"a": None, "b": 2}])
    got = {r.field: (r.missing, r.example) for r in sources.field_audit(rows, ["a", "b"]).collect()}
    assert got == {"a": (0, None), "b": (1, '{"a":"1"}')}


def test_provenance_of_production_follows_the_row(spark):
    rows = raw.normalize(rec.lines(spark, rec.PRODUCTION), "raw_sia.producao_ambulatorial")
    from municare.functions import period_month, period_year

    row = sources.provenance(
        rows, "PARJ2502a", period_year("competencia"), period_month("competencia")
    ).first()
    assert (row._source_file, row._reference_year, row._reference_month) == ("PARJ2502a", 2025, 1)
    assert row._loaded_at is not None


@pytest.mark.parametrize("name, size", [
    ("seed_cnes_natureza_juridica", 22), ("seed_cnes_tipo_unidade", 30), ("seed_fns_ente_municipio", 3),
    ("seed_icsap_cid10", 106), ("seed_previne_brasil_meta", 7), ("seed_sigtap_grupo", 9),
    ("seed_sisab_tipo_indicador", 7),
])
def test_seeds(spark, name, size):
    from importlib import resources

    seed = sources.read_seed(spark, name)
    assert seed.count() == size
    assert seed.schema.simpleString() == spark.createDataFrame([], SEED_SCHEMAS[name]).schema.simpleString()
    path = str(resources.files("municare.seeds").joinpath(f"{name}.csv"))
    stored = sources.read_seed(spark, name, path)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, seed.collect()))


def test_seed_codes_keep_zeros_and_ranges_are_disjoint(spark):
    assert sources.read_seed(spark, "seed_sigtap_grupo").filter("codigo_grupo = '01'").count() == 1
    ranges = sorted((r.cid_inicio, r.cid_fim) for r in sources.read_seed(spark, "seed_icsap_cid10").collect())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert sources.reference_municipalities(spark).agg(F.count("*")).first()[0] == 3
