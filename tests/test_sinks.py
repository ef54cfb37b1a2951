import datetime as dt

import pytest
from pyspark.sql import functions as F

from municare import storage
from municare.sinks import (
    MissingTable,
    compact,
    loads,
    publish,
    read_table,
    read_upserted,
    refresh_incremental,
    replace_partitions,
    stale_partitions,
    sweep,
    table_path,
    upsert,
    versions,
)
from municare.streaming import ingest_landing

SHAPE = "k int, v string, m string"


def rows(spark, *data, shape=SHAPE):
    return spark.createDataFrame(list(data), shape)


def content(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_layer_and_name_are_used_as_given():
    assert table_path("/data/", "marts", "dim_municipio") == "/data/marts/dim_municipio"


def test_replace_is_idempotent_and_leaves_other_partitions(spark, folder):
    first = rows(spark, (1, "a", "202501"), (2, "b", "202502"))
    replace_partitions(first, folder, [{"m": "202501"}, {"m": "202502"}])
    again = rows(spark, (3, "c", "202502"))
    for _ in range(2):
        replace_partitions(again, folder, [{"m": "202502"}])
    stored = read_table(spark, folder, first.schema)
    assert content(stored) == [(1, "a", "202501"), (3, "c", "202502")]


def test_empty_batch_empties_only_the_named_partition(spark, folder):
    first = rows(spark, (1, "a", "202501"), (2, "b", "202502"))
    replace_partitions(first, folder, [{"m": "202501"}, {"m": "202502"}])
    replace_partitions(first.limit(0), folder, [{"m": "202501"}])
    assert content(read_table(spark, folder, first.schema)) == [(2, "b", "202502")]


def test_rows_outside_the_named_partitions_stop_the_write(spark, folder):
    first = rows(spark, (1, "a", "202501"))
    replace_partitions(first, folder, [{"m": "202501"}])
    with pytest.raises(Exception, match="outside the named partitions"):
        replace_partitions(rows(spark, (9, "z", "202501"), (9, "z", "202402")), folder, [{"m": "202501"}])
    assert content(read_table(spark, folder, first.schema)) == content(first)


def test_late_rows_stay_in_their_arrival_partition(spark, folder):
    """The February file carries a January row; loading it twice leaves January alone."""
    shape = "event string, q int, arrival string"
    january = rows(spark, ("202501", 5, "202501"), ("202501", 6, "202501"), shape=shape)
    february = rows(spark, ("202502", 1, "202502"), ("202501", 2, "202502"), shape=shape)
    replace_partitions(january, folder, [{"arrival": "202501"}])
    for _ in range(2):
        replace_partitions(february, folder, [{"arrival": "202502"}])
    by_event = read_table(spark, folder, january.schema).groupBy("event").agg(F.sum("q"))
    assert content(by_event) == [("202501", 13), ("202502", 1)]


def test_two_column_partitions_and_escaped_values(spark, folder):
    shape = "v int, y int, place string"
    first = rows(spark, (1, 2024, "a/b"), (2, 2024, "c"), (3, 2023, "a/b"), (4, 2024, None), shape=shape)
    named = [{"y": y, "place": p} for y, p in ((2024, "a/b"), (2024, "c"), (2023, "a/b"), (2024, None))]
    replace_partitions(first, folder, named)
    assert read_table(spark, folder, first.schema).count() == 4
    for place in ("a/b", None):
        replace_partitions(first.limit(0), folder, [{"y": 2024, "place": place}])
    assert content(read_table(spark, folder, first.schema)) == [(2, 2024, "c"), (3, 2023, "a/b")]


def test_hot_partition_is_written_by_several_tasks(spark, folder):
    big = spark.range(200_000).select(
        F.col("id").cast("int").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(F.lit(7)).cast("string").alias("m"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        replace_partitions(big, folder, [{"m": str(i)} for i in range(50)])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    version = versions.state(spark, folder).parts["m=7"].version
    parts = [n for n in storage.names(spark, f"{folder}/_version={version}/m=7") if n.endswith(".parquet")]
    assert len(parts) > 2
    assert read_table(spark, folder, big.schema).count() == 200_000


def test_upsert_last_write_wins_and_rerun_changes_nothing(spark, folder):
    shape = "k int, v string, _loaded_at timestamp, _source_file string"
    t = [dt.datetime(2025, 1, d) for d in (1, 2)]
    upsert(rows(spark, (1, "a", t[0], "f1"), (2, "b", t[0], "f1"), shape=shape), folder, ["k"], slots=4)
    batch = rows(spark, (2, "old", t[1], "f1"), (2, "new", t[1], "f2"), (3, None, t[1], "f2"), shape=shape)
    for _ in range(2):
        upsert(batch, folder, ["k"], slots=4)
    stored = read_upserted(spark, folder, batch.schema)
    assert content(stored.select("k", "v")) == [(1, "a"), (2, "new"), (3, None)]


def test_upsert_beyond_the_broadcast_check(spark, folder, monkeypatch):
    from municare.sinks import tables

    monkeypatch.setattr(tables, "MAX_BROADCAST_ROWS", 2)
    first = spark.range(50).selectExpr("cast(id as int) as k", "'a' as v", "'x' as m")
    upsert(first, folder, ["k"], ["m"], slots=4)
    upsert(first.filter("k < 20").withColumn("v", F.lit("b")), folder, ["k"], ["m"], slots=4)
    stored = read_upserted(spark, folder, first.schema)
    assert content(stored.groupBy("v").count()) == [("a", 30), ("b", 20)]


def test_many_keys_are_not_sent_through_the_driver(spark, folder, monkeypatch):
    from municare.sinks import tables

    sent, write = [], tables._write

    def seen(rows, *rest, **more):
        sent.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, *rest, **more)

    monkeypatch.setattr(tables, "MAX_BROADCAST_ROWS", 2)
    monkeypatch.setattr(tables, "_write", seen)
    first = spark.range(50).selectExpr("cast(id as int) as k", "'a' as v", "'x' as m")
    for rows_ in (first, first.filter("k < 20")):
        upsert(rows_, folder, ["k"], ["m"])
    assert len(sent) == 3 and "SortMergeJoin" in sent[2] and not any("Broadcast" in p for p in sent)
    with_hashes = tables._holding(first, folder, versions.state(spark, folder), ["k"], False)
    assert sorted(with_hashes) == sorted(versions.state(spark, folder).parts)


def test_a_large_load_shuffles_its_rows_once(spark, folder, monkeypatch):
    from municare.sinks import tables

    sent, write = [], tables._write

    def seen(rows, *rest, gather=True):
        sent.append((rows._jdf.queryExecution().executedPlan().toString(), gather))
        write(rows, *rest, gather=gather)

    monkeypatch.setattr(tables, "MAX_BROADCAST_ROWS", 2)
    monkeypatch.setattr(tables, "_write", seen)
    first = spark.range(300).selectExpr("cast(id as int) as k", "'a' as v", "'x' as m")
    upsert(first, folder, ["k"], ["m", "v"], slots=4)
    assert len(versions.state(spark, folder).parts) == 4
    upsert(first.filter("k < 20").withColumn("v", F.lit("b")), folder, ["k"], ["m", "v"], slots=8)
    assert [(p.count("Exchange "), gather) for p, gather in sent] == [(1, False), (1, False), (2, False)]
    assert not any("xxhash64(k" in p.split("WindowGroupLimit")[-1] for p, _ in sent)
    stored = read_upserted(spark, folder, first.schema)
    assert content(stored.groupBy("v").count()) == [("a", 280), ("b", 20)]
    upsert(first.filter("k > 290"), folder, ["k"], ["m", "v"], slots=8)
    assert content(read_upserted(spark, folder, first.schema).groupBy("v").count()) == [("a", 280), ("b", 20)]


def test_a_load_sorts_small_scans(spark, folder, monkeypatch):
    from municare.session import SCAN_BYTES
    from municare.sinks import tables

    held, write = [], tables._write
    monkeypatch.setattr(tables, "_write", lambda *a, **b: (held.append(spark.conf.get(SCAN_BYTES)), write(*a, **b)))
    before = spark.conf.get(SCAN_BYTES)
    upsert(spark.range(5).selectExpr("id as k", "'x' as m"), folder, ["k"], ["m"])
    spark.conf.set(SCAN_BYTES, "1m")
    try:
        upsert(spark.range(5, 9).selectExpr("id as k", "'x' as m"), folder, ["k"], ["m"])
        assert spark.conf.get(SCAN_BYTES) == "1m"
    finally:
        spark.conf.set(SCAN_BYTES, before)
    assert held == [str(8 << 20), "1m"]


def test_upsert_within_a_period_leaves_other_periods_alone(spark, folder):
    first = rows(spark, (1, "a", "202501"), (2, "b", "202501"), (1, "a", "202502"))
    upsert(first, folder, ["k", "m"], ["v"], within="m")
    january = versions.state(spark, folder).parts["m=202501"]
    upsert(rows(spark, (1, "new", "202502"), (3, "c", "202502")), folder, ["k", "m"], ["v"], within="m")
    assert versions.state(spark, folder).parts["m=202501"] == january
    assert content(read_upserted(spark, folder, first.schema, "m")) == [
        (1, "a", "202501"), (1, "new", "202502"), (2, "b", "202501"), (3, "c", "202502"),
    ]


def test_upsert_refuses_null_keys(spark, folder):
    with pytest.raises(Exception, match="NULL in key"):
        upsert(rows(spark, (None, "a", "x")), folder, ["k"], ["m"])


def test_upsert_of_nothing_changes_nothing(spark, folder):
    upsert(rows(spark, (1, "a", "x")), folder, ["k"], ["m"])
    upsert(rows(spark, (1, "a", "x")).limit(0), folder, ["k"], ["m"])
    assert read_upserted(spark, folder, rows(spark, (1, "a", "x")).schema).count() == 1


STAMPED = "m string, v int, _loaded_at timestamp"
DAY = [dt.datetime(2025, 1, d) for d in range(1, 6)]


def test_incremental_first_load_then_only_stale_partitions(spark, folder):
    source = rows(spark, ("a", 1, DAY[0]), ("b", 2, DAY[0]), shape=STAMPED)
    keep = lambda r: r
    assert refresh_incremental(source, folder, keep, "m") == ["a", "b"]
    assert refresh_incremental(source, folder, keep, "m") == []
    newer = rows(spark, ("a", 1, DAY[0]), ("b", 9, DAY[1]), ("c", 3, DAY[0]), shape=STAMPED)
    # "c" is older than the newest load of the target and still must come in
    assert refresh_incremental(newer, folder, keep, "m") == ["b", "c"]
    assert content(read_table(spark, folder, source.schema).select("m", "v")) == [("a", 1), ("b", 9), ("c", 3)]


def test_existing_but_empty_target_counts_as_first_load(spark, folder):
    source = rows(spark, ("a", 1, DAY[0]), shape=STAMPED)
    source.limit(0).write.partitionBy("m").parquet(folder)
    assert refresh_incremental(source, folder, lambda r: r, "m") == ["a"]


def test_bootstrap_takes_one_partition_even_when_nothing_is_stale(spark, folder):
    source = rows(spark, ("a", 1, DAY[0]), ("b", 2, DAY[0]), shape=STAMPED)
    assert refresh_incremental(source, folder, lambda r: r, "m", only="b") == ["b"]
    assert read_table(spark, folder, source.schema).count() == 1
    changed = source.withColumn("v", F.col("v") * 10)
    assert refresh_incremental(changed, folder, lambda r: r, "m", only="b") == ["b"]
    assert content(read_table(spark, folder, source.schema).select("m", "v")) == [("b", 20)]


def test_schema_sync_adds_and_drops_columns(spark, folder):
    source = rows(spark, ("a", 1, DAY[0]), ("b", 2, DAY[0]), shape=STAMPED)
    refresh_incremental(source, folder, lambda r: r, "m")

    def build(r):
        return r.withColumn("w", F.lit(5)).drop("v")

    newer = rows(spark, ("a", 1, DAY[0]), ("b", 2, DAY[1]), shape=STAMPED)
    assert refresh_incremental(newer, folder, build, "m") == ["b"]
    stored = read_table(spark, folder, build(newer).schema)
    assert stored.columns == ["m", "_loaded_at", "w"]
    assert content(stored.select("m", "w")) == [("a", None), ("b", 5)]


def test_stale_partitions_compares_ledgers(spark):
    have = {"a": 1, "b": 1, "e": None, "z": 1}
    assert stale_partitions({"a": 2, "b": 1, "c": 0, "d": None, "e": None}, have) == ["a", "c", "d"]


def jobs_of(spark, work):
    """How many jobs Spark ran."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_refresh_with_nothing_new_reads_no_rows(spark, folder):
    source = rows(spark, ("a", 1, DAY[0]), ("b", 2, DAY[1]), ("c", None, DAY[1]), shape=STAMPED)
    replace_partitions(source, f"{folder}/raw", [{"m": m} for m in "abc"])
    stored = read_table(spark, f"{folder}/raw", source.schema)

    def build(r):
        return r.filter("v is not null")

    def refresh():
        offered = {m: p.newest for m, p in loads(spark, f"{folder}/raw", "m").items()}
        return refresh_incremental(stored, f"{folder}/fact", build, "m", offered=offered)

    assert refresh() == ["a", "b", "c"]
    assert [p.rows for p in loads(spark, f"{folder}/raw", "m").values()] == [1, 1, 1]
    # "c" came out empty and still counts as built
    assert jobs_of(spark, lambda: refresh() == [] or 1 / 0) == 0
    replace_partitions(rows(spark, ("b", 5, DAY[2]), shape=STAMPED), f"{folder}/raw", [{"m": "b"}])
    stored = read_table(spark, f"{folder}/raw", source.schema)
    assert refresh() == ["b"]
    assert content(read_table(spark, f"{folder}/fact", source.schema).select("m", "v")) == [("a", 1), ("b", 5)]


def test_publish_swaps_a_table_that_feeds_its_own_refresh(spark, folder):
    first = publish(rows(spark, (1, "a", "x")), folder)
    assert content(first) == [(1, "a", "x")]
    grown = first.unionByName(rows(spark, (2, "b", "x")))
    assert content(publish(grown, folder)) == [(1, "a", "x"), (2, "b", "x")]


def folders(spark, folder):
    return [n for n in storage.names(spark, folder) if n.startswith("_version=")]


def test_a_publish_that_stops_before_the_swap_leaves_the_table(spark, folder, monkeypatch):
    publish(rows(spark, (1, "a", "x")), folder)
    monkeypatch.setattr(versions, "commit", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        publish(rows(spark, (2, "b", "x")), folder)
    monkeypatch.undo()
    shape = rows(spark, (1, "a", "x")).schema
    assert content(read_table(spark, folder, shape)) == [(1, "a", "x")]
    publish(rows(spark, (3, "c", "x")), folder)
    assert content(read_table(spark, folder, shape)) == [(3, "c", "x")]
    assert len(folders(spark, folder)) == 3  # valid, before, stopped
    assert len(sweep(spark, folder, older_than=-1)) == 1
    assert len(folders(spark, folder)) == 2
    monkeypatch.setattr(versions, "KEEP_SECONDS", -1)
    publish(rows(spark, (4, "d", "x")), folder)
    publish(rows(spark, (5, "e", "x")), folder)
    assert content(read_table(spark, folder, shape)) == [(5, "e", "x")]
    assert len(folders(spark, folder)) == 2  # what was replaced long ago goes, what was replaced just now stays


def test_a_version_that_another_run_still_writes_stays(spark, folder):
    mine = f"{folder}/_version=other"
    rows(spark, (9, "z", "x")).write.parquet(mine)
    for k in (1, 2, 3):
        publish(rows(spark, (k, "a", "x")), folder)
    assert sweep(spark, folder) == [] and storage.exists(spark, mine)


def test_a_replacement_that_stops_half_way_shows_the_old_rows(spark, folder):
    first = rows(spark, (1, "a", "202501"), (2, "b", "202502"), (3, "c", "202503"))
    months = [{"m": m} for m in ("202501", "202502", "202503")]
    replace_partitions(first, folder, months)
    half = rows(spark, (7, "n", "202501")).unionByName(refuse_all(rows(spark, (8, "n", "202502"))))
    with pytest.raises(Exception, match="stopped"):
        replace_partitions(half, folder, months[:2])

    def late():
        raise ValueError("refused after the write")

    with pytest.raises(ValueError, match="after the write"):
        replace_partitions(rows(spark, (7, "n", "202501")), folder, months, guard=late)
    assert content(read_table(spark, folder, first.schema)) == content(first)
    replace_partitions(rows(spark, (7, "n", "202501")), folder, months[:2])  # filled and emptied together
    assert content(read_table(spark, folder, first.schema)) == [(3, "c", "202503"), (7, "n", "202501")]


def refuse_all(frame):
    from municare.sources.validate import refuse

    return refuse(frame, F.lit(True), "stopped")


def test_two_writers_of_different_partitions_keep_each_others_rows(spark, folder):
    first = rows(spark, (1, "a", "202501"), (2, "b", "202502"))
    replace_partitions(first, folder, [{"m": "202501"}, {"m": "202502"}])

    def other():
        replace_partitions(rows(spark, (8, "o", "202502"), (9, "o", "202503")), folder, [{"m": "202502"}, {"m": "202503"}])

    replace_partitions(rows(spark, (7, "n", "202501")), folder, [{"m": "202501"}], guard=other)
    assert content(read_table(spark, folder, first.schema)) == [
        (7, "n", "202501"), (8, "o", "202502"), (9, "o", "202503"),
    ]


def test_writers_at_the_same_time(spark, folder):
    from concurrent.futures import ThreadPoolExecutor

    def load(i):
        upsert(rows(spark, (i, "own", "x"), (100, f"by {i}", "x")), folder, ["k"], ["m"])

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(load, range(4)))
    stored = content(read_upserted(spark, folder, rows(spark, (1, "a", "x")).schema))
    assert [r[0] for r in stored] == [0, 1, 100, 2, 3]


def test_an_upsert_that_another_one_came_before_looks_again(spark, folder):
    upsert(rows(spark, (1, "a", "x"), (2, "a", "x")), folder, ["k"], ["m"])
    calls = []

    def other():
        calls.append(1)
        upsert(rows(spark, (2, "other", "x"), (3, "other", "x")), folder, ["k"], ["m"])

    real = versions.commit
    first = [True]

    def late(*a, **b):
        if first.pop() if first else False:
            other()
        return real(*a, **b)

    versions.commit, undo = late, real
    try:
        upsert(rows(spark, (3, "mine", "x")), folder, ["k"], ["m"])
    finally:
        versions.commit = undo
    stored = content(read_upserted(spark, folder, rows(spark, (1, "a", "x")).schema))
    assert stored == [(1, "a", "x"), (2, "other", "x"), (3, "mine", "x")]


def test_a_first_load_that_stops_leaves_no_table(spark, folder):
    bad = rows(spark, (1, "a", "x"), (None, "b", "x"))
    with pytest.raises(Exception, match="NULL in key"):
        upsert(bad, folder, ["k"], ["m"])
    with pytest.raises(MissingTable):
        read_upserted(spark, folder, bad.schema, may_be_empty=False)
    upsert(bad.filter("k is not null"), folder, ["k"], ["m"])
    assert read_upserted(spark, folder, bad.schema, may_be_empty=False).count() == 1


def test_a_load_that_touches_few_keys_leaves_most_pieces(spark, folder):
    month = lambda i, v: spark.range(i * 100, i * 100 + 100).selectExpr(
        "cast(id as int) as k", f"'{v}' as v", f"'{i}' as m"
    )
    for i in range(12):
        upsert(month(i, "a"), folder, ["k"], ["m"], slots=4)
    before = versions.state(spark, folder).parts
    assert len(before) == 48
    late = month(3, "late").filter("k < 306").unionByName(month(12, "a"))
    upsert(late, folder, ["k"], ["m"], slots=4)
    after = versions.state(spark, folder).parts
    assert sum(after.get(n) == p for n, p in before.items()) >= 44 and set(before) <= set(after)
    stored = read_upserted(spark, folder, late.schema)
    assert stored.count() == 1300 and stored.select("k").distinct().count() == 1300
    assert content(stored.groupBy("v").count()) == [("a", 1294), ("late", 6)]
    assert compact(spark, folder, late.schema, ["k"], 60) == 52
    assert len(versions.state(spark, folder).parts) < 10
    upsert(late.withColumn("v", F.lit("b")), folder, ["k"], ["m"])
    assert content(read_upserted(spark, folder, late.schema).groupBy("v").count()) == [("a", 1194), ("b", 106)]


def test_another_number_of_slots_keeps_each_key_once(spark, folder):
    first = spark.range(300).selectExpr("cast(id as int) as k", "'a' as v", "'x' as m")
    upsert(first, folder, ["k"], ["m"], slots=8)
    for slots, v in ((16, "b"), (None, "c"), (4, "d")):
        upsert(first.filter("k < 5").withColumn("v", F.lit(v)), folder, ["k"], ["m"], slots=slots)
        stored = read_upserted(spark, folder, first.schema)
        assert content(stored.groupBy("v").count()) == [("a", 295), (v, 5)]


def test_place_in_the_load_settles_equal_stamps(spark, folder):
    batch = spark.range(200).selectExpr("cast(id % 100 as int) as k", "cast(id as string) as v", "'x' as m", "id as at")
    upsert(batch, folder, ["k"], ["m"], slots=4, order_only=["at"])
    stored = read_upserted(spark, folder, batch.drop("at").schema)
    assert stored.count() == 100 and stored.filter("cast(v as int) < 100").count() == 0


def test_a_table_never_written_can_be_an_error(spark, folder):
    shape = rows(spark, (1, "a", "x")).schema
    assert read_table(spark, f"{folder}/none", shape).count() == 0
    for read in (read_table, read_upserted):
        with pytest.raises(MissingTable, match="none"):
            read(spark, f"{folder}/none", shape, may_be_empty=False)


def test_an_absent_bootstrap_period_changes_nothing(spark, folder):
    source = rows(spark, ("a", 1, DAY[1]), ("b", 2, DAY[0]), shape=STAMPED)
    column = source.columns[0]
    refresh_incremental(source, folder, lambda r: r, column, loaded_at=source.columns[2], only="a")
    without = source.filter(F.col(column) != "a")
    assert refresh_incremental(without, folder, lambda r: r, column, loaded_at=source.columns[2], only="a") == []
    assert read_table(spark, folder, source.schema).count() == 1


def test_landing_stream_completes_a_period_in_two_visits(spark, folder):
    schema = rows(spark, (1, "a", "x")).schema

    def land(*data):
        rows(spark, *data).write.mode("append").partitionBy("m").parquet(f"{folder}/landing")

    def visit():
        ingest_landing(spark, f"{folder}/landing", schema, f"{folder}/table", f"{folder}/state", "m")
        return content(read_table(spark, f"{folder}/table", schema))

    land((1, "a", "202501"), (2, "b", "202502"))
    assert visit() == [(1, "a", "202501"), (2, "b", "202502")]
    land((3, "c", "202501"))
    expected = [(1, "a", "202501"), (2, "b", "202502"), (3, "c", "202501")]
    assert visit() == expected
    assert visit() == expected
