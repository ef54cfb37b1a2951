import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from municare import operators as op
from municare.operators import overlapping, quality, skew, sweep_lookup
from municare.operators.quality import Check


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_left_lookup_keeps_unknown_codes(spark):
    rows = spark.createDataFrame([("a",), ("z",), (None,)], "code string")
    names = spark.createDataFrame([("a", "Alpha")], "code string, name string")
    got = op.left_lookup(rows, names, {"code": "code"}, {"name": "label"})
    assert Counter(map(tuple, got.collect())) == Counter([("a", "Alpha"), ("z", None), (None, None)])


def test_role_lookup_joins_the_same_dimension_twice(spark):
    facts = spark.createDataFrame([(1, "x", "y"), (2, "y", "?")], "id int, place string, home string")
    places = spark.createDataFrame([("x", 10), ("y", 20)], "code string, id int")
    got = op.role_lookup(facts, places, "code", "id", {"place": "place_id", "home": "home_id"})
    assert sorted((r.id, r.place_id, r.home_id) for r in got.collect()) == [(1, 10, 20), (2, 20, None)]


def test_membership_and_scope(spark):
    rows = spark.range(4).toDF("k")
    members = spark.createDataFrame([(1,), (1,), (3,)], "k long")
    flagged = op.membership_flag(rows, members, {"k": "k"}, "listed")
    assert {r.k: r.listed for r in flagged.collect()} == {0: False, 1: True, 2: False, 3: True}
    scoped = op.keep_scope(rows, members.distinct(), {"k": "k"})
    assert sorted(r.k for r in scoped.collect()) == [1, 3]


def test_bounded_marks_only_small_tables(spark):
    big = spark.range(100).toDF("k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(10).toDF("r")
        small = rows.join(op.bounded(big, 100), F.expr("r = k"))
        large = rows.join(op.bounded(big, 99), F.expr("r = k"))
        heavy = rows.join(op.bounded(big, 100, max_bytes=10), F.expr("r = k"))
        assert "SortMergeJoin" in plan(heavy)
        assert "BroadcastHashJoin" in plan(small)
        assert "SortMergeJoin" in plan(large)
        assert small.count() == large.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_aggregate_then_label_keeps_unknown_groups(spark):
    rows = spark.createDataFrame([("01", 1), ("01", 2), ("10", 4)], "g string, v int")
    names = spark.createDataFrame([("01", "one")], "g string, name string")
    got = op.aggregate_then_label(rows, ["g"], [F.sum("v").alias("v")], "g", names, "g", {"name": "name"})
    assert sorted(map(tuple, got.collect())) == [("01", 3, "one"), ("10", 4, None)]


def test_latest_per_key_null_is_newest_and_ties_are_stable(spark):
    rows = spark.createDataFrame(
        [("a", "202501", 1), ("a", "202503", 2), ("b", None, 3), ("b", "202512", 4), ("c", "202501", 5), ("c", "202501", 6)],
        "k string, p string, v int",
    )
    first = {r.k: r.v for r in op.latest_per_key(rows, ["k"], ["p"]).collect()}
    again = {r.k: r.v for r in op.latest_per_key(rows.orderBy(F.desc("v")), ["k"], ["p"]).collect()}
    assert (first["a"], first["b"]) == (2, 3)
    assert first == again


def test_latest_per_key_reduces_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("p"))
    text = plan(op.latest_per_key(rows, ["k"], ["p"]))
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


MONTHS = [dt.date(2025, m, 1) for m in (1, 2, 3)]


def test_presence_status(spark):
    rows = spark.createDataFrame(
        [("all", MONTHS[0]), ("all", MONTHS[1]), ("all", MONTHS[2]), ("gone", MONTHS[0]),
         ("gone", MONTHS[1]), ("new", MONTHS[2]), (None, MONTHS[0])],
        "k string, p date",
    )
    got = op.presence_status(rows, "k", "p", "first", "last", "status")
    assert {(r.k, r.p.month): (r.first.month, r.last.month, r.status) for r in got.collect()} == {
        ("all", 1): (1, 3, "historico"),
        ("all", 2): (1, 3, "historico"),
        ("all", 3): (1, 3, "ativo"),
        ("gone", 1): (1, 2, "historico"),
        ("gone", 2): (1, 2, "possivelmente_encerrado"),
        ("new", 3): (3, 3, "ativo"),
        (None, 1): (1, 1, "possivelmente_encerrado"),
    }


def test_hot_key_is_dealt_to_many_slots(spark):
    """A third of the rows are copies of one row; nothing is lost and no reducer gets them all."""
    hot = spark.range(0, 6000, 1, 4).select(F.lit("hot").alias("k"), F.lit(1).alias("p"))
    cold = spark.range(0, 12000, 1, 4).select(
        F.concat(F.lit("k"), F.col("id") % 4000).alias("k"), (F.col("id") % 3).cast("int").alias("p")
    )
    rows = hot.unionByName(cold)
    facts = rows.groupBy("k").agg(F.max("p").alias("last"), F.count("*").alias("n"))
    joined = skew.join_facts_back(rows, facts, ["k"], "n", shares=100)
    assert joined.columns == ["k", "p", "last"]
    assert joined.count() == 18000
    assert joined.filter("k = 'hot' and last = 1").count() == 6000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = skew.join_facts_back(rows, facts, ["k"], "n", shares=100)
        loads = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(loads) == 18000
    assert max(loads) < 2500


RANGES = [(1, "A370", "A379"), (1, "G000", "G000"), (2, "I200", "I209"), (3, "J130", "J149"), (4, "A900", "B099")]


def test_range_lookup_end_points_gaps_and_padding(spark):
    ranges = spark.createDataFrame(RANGES, "g int, lo string, hi string")
    codes = ["A370", "A379", "A380", "G000", "G001", "I20", "J15", "B05", "A95", "A3701", "", None]
    rows = spark.createDataFrame([(c,) for c in codes], "code string")
    from municare.functions import complete_category

    got = op.resolve_codes(rows, "code", complete_category("code"), ranges, "lo", "hi", {"g": "g"})
    found = {r.code: r.g for r in got.collect()}
    expected = {}
    for code in codes:
        full = code + "0" if code is not None and len(code) == 3 else code
        hits = [g for g, lo, hi in RANGES if full is not None and lo <= full <= hi]
        expected[code] = hits[0] if hits else None
    assert found == expected
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_range_lookup_against_brute_force(spark):
    """Random ranges, some over several initials, some inverted, codes of any length."""
    draw = random.Random(7)

    def code():
        return "".join(draw.choice("ABCDÉ019") for _ in range(draw.randint(1, 4)))

    spans = [tuple(sorted((code(), code()))) for _ in range(60)] + [("Z", "A"), ("B", "B")]
    codes = sorted({code() for _ in range(400)})
    ranges = spark.createDataFrame([(i, lo, hi) for i, (lo, hi) in enumerate(spans)], "g int, lo string, hi string")
    rows = spark.createDataFrame([(c,) for c in codes], "code string")
    got = op.range_lookup(rows, "code", ranges, "lo", "hi", {"g": "g"}).collect()
    expected = Counter()
    for c in codes:
        key = c.encode()
        hits = [g for g, (lo, hi) in enumerate(spans) if lo.encode() <= key <= hi.encode()]
        expected.update((c, g) for g in hits or [None])
    assert Counter(map(tuple, got)) == expected


def test_presence_status_against_brute_force(spark):
    draw = random.Random(11)
    data = sorted({("k%d" % (draw.randint(0, 40) ** 2 % 23), draw.randint(1, 12)) for _ in range(200)})
    rows = spark.createDataFrame(data, "k string, p int")
    newest = max(p for _, p in data)
    expected = {}
    for k, p in data:
        mine = [q for j, q in data if j == k]
        status = "historico" if p < max(mine) else "ativo" if max(mine) == newest else "possivelmente_encerrado"
        expected[k, p] = (min(mine), max(mine), status)
    got = op.presence_status(rows, "k", "p", "first", "last", "status").collect()
    assert len(got) == len(data)
    assert {(r.k, r.p): (r.first, r.last, r.status) for r in got} == expected


def test_range_lookup_overlap_gives_one_row_each(spark):
    ranges = spark.createDataFrame([(1, "A", "C"), (2, "B", "D")], "g int, lo string, hi string")
    rows = spark.createDataFrame([("B5",)], "code string")
    got = op.range_lookup(rows, "code", ranges, "lo", "hi", {"g": "g"})
    assert sorted(r.g for r in got.collect()) == [1, 2]


def test_label_pair_pairs_copies_like_the_source_database(spark):
    rows = spark.createDataFrame(
        [(1, "a", 5), (1, "a", 5), (1, "m", 9), (1, "m", 9), (2, "a", 1), (3, "m", 1)], "k int, l string, v int"
    )
    got = op.label_pair(rows, ["k"], "l", "v", ("a", "applied"), ("m", "minimum"))
    assert [tuple(r) for r in got.collect()] == [(1, 5, 9)] * 4


def test_alert_without_municipality_has_no_id(spark):
    rows = spark.createDataFrame([(1,), (None,)], "id_municipio int")
    names = spark.createDataFrame([(1, "X")], "id_municipio int, nome_municipio string")
    found = op.federate_rules([op.rule(rows, "r", "d", "alta", F.lit("p"), F.lit("e"))], names)
    got = {r.id_municipio: r for r in found.collect()}
    assert got[None].id_alerta is None and got[None].nome_municipio is None
    assert got[1].nome_municipio == "X" and len(got[1].id_alerta) == 32
    assert {r.status for r in got.values()} == {"ativo"}


def test_upsert_rows_replaces_every_column_even_with_an_older_stamp(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 5)], "k int, v string, t int")
    new = spark.createDataFrame([(2, None, 2), (2, "x", 1), (3, "c", 2)], "k int, v string, t int")
    got = op.upsert_rows(old, new, ["k"], ["t"])
    assert sorted(map(tuple, got.collect())) == [(1, "a", 5), (2, None, 2), (3, "c", 2)]


def test_spread_lookup_equals_left_lookup_with_hot_and_missing_keys(spark):
    rows = spark.range(0, 3000, 1, 4).select(
        "id", F.expr("case id % 3 when 0 then 'hot' when 1 then null else 'k' || id % 50 end").alias("k")
    )
    table = spark.range(0, 30).selectExpr("'k' || id as c", "id as n").union(
        spark.sql("values ('hot', 99L), ('k1', 1000L), (null, 5L)")
    )
    plain = op.left_lookup(rows, table, {"k": "c"}, {"n": "n"})
    spread = op.spread_lookup(rows, table, {"k": "c"}, {"n": "n"}, shares=10)
    assert spread.columns == plain.columns
    assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, plain.collect()))


def test_keep_other_partitions_with_an_empty_batch(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "p string, v int")
    got = op.keep_other_partitions(rows, rows.limit(0), F.col("p") == "a")
    assert sorted(r.v for r in got.collect()) == [2, 3]


def test_quality_counts_and_severity(spark):
    child = spark.createDataFrame(
        [(1, "a"), (1, "b"), (None, "x"), (4, None)], "k int, s string"
    )
    parent = spark.createDataFrame([(1,), (None,)], "k int")
    checks = [
        Check("child", "k", "unique"),
        Check("child", "k", "not_null"),
        Check("child", "s", "accepted_values", ("a", "b")),
        Check("child", "k", "relationships", parent="parent", parent_column="k", severity="warn"),
    ]
    results = quality.run(checks, {"child": child, "parent": parent})
    assert {(r.test, r.severity): r.failures for r in results.collect()} == {
        ("unique", "error"): 1,
        ("not_null", "error"): 1,
        ("accepted_values", "error"): 1,
        ("relationships", "warn"): 1,
    }
    with pytest.raises(quality.QualityError, match="child.k unique: 1"):
        quality.enforce(results)
    quality.enforce(results.filter("severity = 'warn'"))


def brute_pairs(codes, ranges):
    return sorted(((c, i) for c in codes for i, a, b in ranges if c is not None and None not in (a, b) and a <= c <= b), key=str)


def test_sweep_lookup_against_brute_force(spark):
    rng = random.Random(4)
    codes = [rng.randint(0, 40_000) for _ in range(3_000)] + [None, 7, 7]
    ranges = [(i, a, a + rng.choice([0, 3, 50, 39_000])) for i, a in enumerate(rng.randint(0, 40_000) for _ in range(400))]
    ranges += [(900, 5, None), (901, None, 5), (902, 9, 2), (903, 0, 50_000), (904, 0, 50_000)]
    rows = spark.createDataFrame([(c,) for c in codes], "code int")
    sides = spark.createDataFrame(ranges, "id int, a int, b int")
    got = sweep_lookup(rows, "code", sides, "a", "b", {"id": "id"})
    found = sorted(((r.code, r.id) for r in got.collect() if r.id is not None), key=str)
    assert found == brute_pairs(codes, ranges)
    assert got.filter("code is null").count() == 1  # a left join


@pytest.mark.parametrize("kind", ["string", "date", "double"])
def test_sweep_lookup_takes_any_ordered_key(spark, kind):
    make = {"string": "lpad(cast(id as string), 3, '0')", "date": "date_add(date '2020-01-01', cast(id as int))", "double": "id / 4"}[kind]
    rows = spark.range(60).selectExpr(f"{make} as code")
    sides = spark.range(0, 60, 7).selectExpr("id", f"{make} as a").withColumn(
        "b", F.expr({"string": "'030'", "date": "date_add(a, 9)", "double": "a + 2.5"}[kind])
    )
    got = sweep_lookup(rows, "code", sides, "a", "b", {"id": "id"}).filter("id is not null")
    want = rows.crossJoin(sides).filter("code between a and b").select("code", "id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_sweep_covers_whole_blocks_once(spark, monkeypatch):
    from municare.operators import ranges as module

    monkeypatch.setattr(module, "BLOCK", 4)
    rows = spark.range(300).selectExpr("id as code")
    sides = spark.createDataFrame([(1, 0, 299), (2, 3, 3), (3, 15, 16), (4, 16, 255), (5, 298, 400)], "id int, a long, b long")
    got = sweep_lookup(rows, "code", sides, "a", "b", {"id": "id"}).filter("id is not null")
    counts = {r.id: (r["count"], r.n) for r in got.groupBy("id").agg(F.count("*").alias("count"), F.countDistinct("code").alias("n")).collect()}
    assert counts == {1: (300, 300), 2: (1, 1), 3: (2, 2), 4: (240, 240), 5: (2, 2)}


def test_overlapping_names_the_range_that_reaches_farthest(spark):
    rng = random.Random(9)
    sides = [(i, a, a + rng.choice([0, 1, 40])) for i, a in enumerate(rng.randint(0, 3_000) for _ in range(500))]
    sides += [(600, None, 3), (601, 9, 2)]
    got = overlapping(spark.createDataFrame(sides, "name int, a int, b int").repartition(7), "name", "a", "b")
    order = sorted((a, b, n) for n, a, b in sides if None not in (a, b) and a <= b)
    want = []
    for i, (a, b, n) in enumerate(order):
        far = max(((y, m) for _, y, m in order[:i]), default=(-1, 0))
        if far[0] >= a:
            want.append((n, a, b, far[1], far[0]))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    apart = spark.range(50).selectExpr("id as name", "id * 10 as a", "id * 10 + 9 as b")
    assert overlapping(apart, "name", "a", "b").count() == 0


def test_quality_reads_every_table_once(spark, folder):
    for name in ("child", "parent"):
        spark.range(50).selectExpr("id as a", "cast(id % 7 as string) as b", "id % 60 as c").write.parquet(f"{folder}/{name}")
    tables = {name: spark.read.parquet(f"{folder}/{name}") for name in ("child", "parent")}
    checks = [
        Check("child", "a", "unique"), Check("child", "b", "unique"), Check("child", "b", "not_null"),
        Check("child", "b", "accepted_values", ("0", "1")), Check("child", "a", "relationships", parent="parent", parent_column="c"),
        Check("child", "b", "relationships", parent="parent", parent_column="a"), Check("parent", "a", "unique"),
    ]
    got = quality.run(checks, tables)
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("FileScan parquet") == 2
    assert [r.failures for r in got.collect()] == [0, 7, 0, 35, 0, 0, 0]


def test_checks_ask_rows_only_where_one_fails_and_in_compiled_code(spark):
    from municare.operators import quality
    from municare.operators.quality import Check

    rows = spark.createDataFrame([(1, "a"), (1, None), (None, "c")], "k int, v string")
    only = spark.createDataFrame([(None, "x"), (2, "y")], "k int, v string")
    checks = [Check("t", "k", "unique"), Check("t", "v", "not_null"), Check("u", "k", "not_null"), Check("u", "v", "accepted_values", ("x",))]
    found = quality.run(checks, {"t": rows, "u": only})
    assert sorted(r.failures for r in found.collect()) == [1, 1, 1, 1]
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in text and text.count("Generate inline") == 2
