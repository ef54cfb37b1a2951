"""Registered queries on the smallest test tables, and the pipeline against its stages."""

import hashlib
from pathlib import Path

import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from municare.llm.queries import VOCABULARY
from municare.llm.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted((tuple(plain(r[names.index(c)]) for c in got.columns) for r in found.fetchall()), key=str)
    assert sorted((tuple(map(plain, r)) for r in got.collect()), key=str) == want


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            out.write.parquet(f"{tmp_path}/{i}")
            before, docs = docs, spark.read.parquet(f"{tmp_path}/{i}")
            count = (before.count(), docs.count(), docs.select("doc_id").distinct().count())
            assert [count[1] < count[0], count[1] < count[0], count[1] <= count[0], count[2] < count[1]][i]
    result = sorted(tuple(r) for r in out.collect())
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = []
    for r in docs.collect():
        ids = tokenizer.encode(r["text"], add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), r["text"]))))
    assert result == sorted(want)
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, FOLDER).collect()) == result
