"""Every registered query against its SQL, on the smallest test tables."""

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from municare.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SQL = ORACLES
TYPES = {"bigint": "bigint", "int": "integer", "string": "varchar", "double": "double",
         "date": "date", "boolean": "boolean"}

UNWANTED = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    if isinstance(value, (dt.date, dt.datetime, Decimal)):
        return str(value)
    return value


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in UNWANTED if word in plan]
    columns = sorted(got.columns)
    found = duck.execute(SQL[name])
    types = {d[0]: str(d[1]).lower() for d in found.description}
    assert sorted(types) == columns
    assert {f.name: TYPES[f.dataType.simpleString()] for f in got.schema} == types
    names = list(types)
    expected = [[r[names.index(c)] for c in columns] for r in found.fetchall()]
    assert ordered(got.select(*[f"`{c}`" for c in columns]).collect()) == ordered(expected)
