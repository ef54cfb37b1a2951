"""What the physical plans of the large models hold."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from municare.catalog.landed import raw_tables
from municare.plans import Workspace

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not here")


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def space(spark):
    return Workspace(spark, raw_tables(spark, FOLDER))


def test_production_fact_is_map_only(space):
    text = plan(space["fct_producao_ambulatorial"])
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text


def test_group_mart_shuffles_partial_totals_once(space):
    text = plan(space["mart_producao_grupo_municipio"])
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text and text.index("Exchange hashpartitioning") < text.index("partial_sum")


def test_history_reads_the_newest_period_as_a_scalar(space):
    text = plan(space["mart_historico_rede_cnes"])
    assert "Window" not in text
    assert "Subquery" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["mart_icsap_municipio"](spark, FOLDER))
    scan = [line for line in text.splitlines() if "FileScan parquet" in line and "o_orderkey" in line][0]
    assert "o_totalprice" not in scan and "o_orderstatus" not in scan


def test_refresh_prunes_partitions_and_takes_the_newest_load_from_two_columns(spark, space, folder):
    from pyspark.sql import functions as F

    from municare.sinks import read_table

    raw = space["raw_sia.producao_ambulatorial"].filter("competencia_arquivo like '1997%'")
    raw.write.partitionBy("competencia_arquivo").parquet(folder)
    stored = read_table(spark, folder, raw.schema)
    staged = Workspace(spark, {"raw_sia.producao_ambulatorial": stored})["stg_sia__producao_ambulatorial"]
    one = plan(staged.filter(F.col("competencia_arquivo").isin("199703")))
    assert "PartitionFilters: [(competencia_arquivo" in one or "PartitionFilters: [isnotnull(competencia_arquivo" in one
    newest = plan(staged.groupBy("competencia_arquivo").agg(F.max("_loaded_at")))
    scan = [line for line in newest.splitlines() if "FileScan parquet" in line][0]
    assert "FileScan parquet [_loaded_at" in scan and "valor_produzido" not in scan


def test_group_mart_over_the_stored_fact_reads_what_it_sums(spark, space, folder):
    from municare.plans import MODELS
    from municare.sinks import read_table

    fact = space["fct_producao_ambulatorial"]
    fact.write.partitionBy("competencia_arquivo").parquet(folder)
    mart = MODELS["mart_producao_grupo_municipio"]
    text = plan(mart.build(read_table(spark, folder, fact.schema), space["seed_sigtap_grupo"]))
    scan = [line for line in text.splitlines() if "FileScan parquet" in line][0]
    assert "PushedFilters: [IsNotNull(id_municipio_estabelecimento)" in scan
    for unused in ("codigo_cbo", "idade_paciente", "origem_documento", "_loaded_at"):
        assert unused not in scan
    assert text.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in text
