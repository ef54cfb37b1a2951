"""Loads that follow one another: by location, all or nothing, by ledger, guarded; and interval sweeps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from municare import storage
from municare.catalog import landed
from municare.catalog.landed import code6, id7
from municare.catalog.registry import comparable, query, table
from municare.catalog.writes import ARRIVED, LINE_KEYS, MONEY, _arrivals, _orders_by_month, _periods
from municare.intake import ingest_file, ingest_json, open_raw
from municare.operators import distinct_counts, distinct_state, overlapping, sweep_lookup
from municare.session import shared_folder
from municare.sinks import (
    loads,
    read_table,
    read_upserted,
    refresh_incremental,
    replace_partitions,
    upsert,
)
from municare.sources.validate import refuse
from municare.streaming import ingest_landing_parts


@query(
    "q46_upsert_by_location",
    """
with lines as (
    select l_orderkey, l_linenumber, max(cast(l_quantity as bigint)) as q, month(max(l_shipdate)) as m
    from lineitem group by 1, 2)
select l_orderkey, l_linenumber, q + case when l_linenumber = 1 and m < 12 then 1 else 0 end as q,
    case when l_linenumber = 1 and m < 12 then 'again' else 'first' end as told
from lines""",
)
def upsert_by_location(spark: SparkSession, folder: str) -> DataFrame:
    """Twelve months loaded one by one; each load sends first lines of the month before again, corrected."""
    lines = table(spark, folder, "lineitem").groupBy(*LINE_KEYS).agg(
        F.max("l_quantity").cast("bigint").alias("q"), F.month(F.max("l_shipdate")).alias("m")
    )
    path = shared_folder(spark, "located")
    for month in range(1, 13):
        new = lines.filter(F.col("m") == month).withColumn("told", F.lit("first"))
        old = lines.filter((F.col("m") == month - 1) & (F.col("l_linenumber") == 1))
        old = old.withColumns({"q": F.col("q") + 1, "told": F.lit("again")})
        upsert(new.unionByName(old).drop("m"), path, LINE_KEYS, ["told"])
    shape = new.drop("m").schema
    return read_upserted(spark, path, shape)


@query(
    "q47_replace_all_or_nothing",
    """
with changed as (
    select strftime(o_orderdate, '%Y%m') as m, cast(o_totalprice as decimal(18,2))
        + case when strftime(o_orderdate, '%Y%m') = '199706' then 1 else 0 end as v from orders)
select m, count(*) as n, cast(sum(v) as double) as total from changed where m <> '199801' group by m""",
)
def replace_all_or_nothing(spark: SparkSession, folder: str) -> DataFrame:
    """A replacement that stops half way, one that is refused after its rows were written, and one that
    fills a month and empties another in the same commit."""
    rows = _orders_by_month(spark, folder)
    path = shared_folder(spark, "whole")
    replace_partitions(rows, path, [{"m": p} for p in _periods(rows, "m")])
    named = [{"m": "199706"}, {"m": "199801"}]
    june = rows.filter("m = '199706'").withColumn("v", (F.col("v") + 1).cast(MONEY))
    wrong = june.withColumn("v", (F.col("v") * 2).cast(MONEY))
    half = wrong.unionByName(refuse(rows.filter("m = '199801'"), F.lit(True), "stopped half way"))

    def refused() -> None:
        raise ValueError("refused after the write")

    _must_stop(lambda: replace_partitions(half, path, named), "stopped half way")
    _must_stop(lambda: replace_partitions(wrong, path, named, guard=refused), "refused after the write")
    replace_partitions(june, path, named)
    stored = read_table(spark, path, rows.schema)
    return comparable(stored.groupBy("m").agg(F.count("*").alias("n"), F.sum("v").alias("total")))


def _must_stop(load: Callable[[], None], told: str) -> str:
    """The error of this library that a load stops with, or that its job was stopped; a load that goes
    through is an error here."""
    try:
        load()
    except Exception as stopped:  # noqa: BLE001
        if told not in str(stopped):
            raise
        ours = type(stopped).__module__.startswith("municare.")
        return type(stopped).__name__ if ours else "stopped job"
    raise AssertionError(f"a load that should say '{told}' went through")


@query(
    "q48_refresh_by_ledger",
    f"""
select event, count(*) as n, cast(sum(q + case when arrival = '199801' then 1 else 0 end) as bigint) as q,
    max(case when arrival = '199801' then date '2025-02-15' else date '2025-01-15' end) as newest
from {ARRIVED} where arrival <> '199707' group by event""",
)
def refresh_by_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The raw table keeps the newest load of each arrival with its pointer, and so does the fact: a refresh
    compares the two. One arrival is loaded again, and one comes out of the build empty."""
    rows = _arrivals(spark, folder)
    raw, fact = shared_folder(spark, "raw"), shared_folder(spark, "fact")
    replace_partitions(rows, raw, [{"arrival": p} for p in _periods(rows, "arrival")])

    def refresh() -> list:
        offered = {value: part.newest for value, part in loads(spark, raw, "arrival").items()}
        source = read_table(spark, raw, rows.schema)
        build = lambda r: r.filter("arrival != '199707'")
        return refresh_incremental(source, fact, build, "arrival", aligned=True, offered=offered)

    first = refresh()
    corrected = read_table(spark, raw, rows.schema).filter("arrival = '199801'").withColumns(
        {"q": F.col("q") + 1, "_loaded_at": F.lit("2025-02-15 00:00:00").cast("timestamp")}
    )
    replace_partitions(corrected, raw, [{"arrival": "199801"}])
    second, third = refresh(), refresh()
    if ("199707" not in first, second, third) != (False, ["199801"], []):
        raise AssertionError(f"rebuilt {second}, then {third}")
    return read_table(spark, fact, rows.schema).groupBy("event").agg(
        F.count("*").alias("n"), F.sum("q").alias("q"), F.max(F.to_date("_loaded_at")).alias("newest")
    )


INDICATORS = "raw_sisab.indicador_desempenho"
TEAMS = "raw_cnes.equipes_aps"
PAGE = 500  # records of an answer, below the page limit
GUARDS = (
    ("answer without records", "EmptySource"),
    ("answer as large as its page", "PageLimitReached"),
    ("answer without its envelope", "stopped job"),
    ("record without a required field", "stopped job"),
    ("record without a required value", "MissingValue"),
    ("record outside the named partitions", "stopped job"),
    ("no landed file", "EmptySource"),
    ("landed file without rows", "EmptySource"),
    ("place without a state", "stopped job"),
    ("place without a population", "stopped job"),
    ("first load that stops", "MissingTable"),
)
_TOLD = ", ".join(f"('{guard}', '{error}')" for guard, error in GUARDS)


@query(
    "q49_guards",
    f"""
select guard, error, (select count(*) from part) as stored, (select cast(sum(p_partkey) as bigint) from part) as keys
from (values {_TOLD}) as t(guard, error)""",
)
def guards(spark: SparkSession, folder: str) -> DataFrame:
    """Every guard of the loads met by a damaged answer or file: the error it raises, and the rows of a table
    loaded before, which must be all there afterwards."""
    root, landing = shared_folder(spark, "lake"), shared_folder(spark, "landing")
    parts = table(spark, folder, "part")
    record = F.expr(f"""named_struct(
        'uf', 'RJ', 'municipio', p_name, 'codigo_municipio', int({code6("p_partkey % 25")}),
        'quadrimestre', "2024Q3", 'competencia', 202412,
        'codigo_tipo_indicador', (p_size % 8 + 1) * 10, 'visao_equipe', p_type,
        'numerador', p_partkey, 'denominador_utilizador', 1, 'denominador_identificado', 1,
        'denominador_estimado', 1, 'percentual', 1, 'percentual_quadrimestre', 1,
        'cadastro', 1, 'base_externa', 1, 'populacao', 1)""")
    rows = parts.select("p_partkey", record.alias("r"), (F.col("p_partkey") / PAGE).cast("long").alias("page"))
    asked = parts.selectExpr(f"int({code6('p_partkey % 25')}) as c").distinct().orderBy("c").collect()  # places
    named = [{"codigo_municipio": r["c"], "quadrimestre": "2024Q3"} for r in asked]

    def answers(name: str, pages: DataFrame) -> str:
        """One file per page (r list of records)."""
        body = F.to_json(F.struct(F.col("r").alias("sisab_indicador_desempenho")), {"ignoreNullFields": "false"})
        path = f"{landing}/{name}"
        pages.select(body).write.option("maxRecordsPerFile", 1).text(path)
        return path

    def load(path: str, partitions: list | None = None, into: str = root) -> None:
        ingest_json(spark, path, into, INDICATORS, "https://x", None, partitions or named)

    pages = rows.groupBy("page").agg(F.collect_list("r").alias("r"))
    load(answers("good", pages))
    one = rows.orderBy("p_partkey").limit(1)
    held = one.select(F.array("r").alias("r"))

    def damaged(name: str, change: Callable[[Column], Column]) -> str:
        return answers(name, one.select(F.array(change(F.col("r"))).alias("r")))

    outcomes = []

    def expect(guard: str, run: Callable[[], None], told: str) -> None:
        outcomes.append((guard, _must_stop(run, told)))

    empty = answers("empty", pages.select("r").unionByName(held.select(F.filter("r", lambda _: F.lit(False)).alias("r"))))
    expect(GUARDS[0][0], lambda: load(empty), "holds no records")
    full = answers("full", one.select(F.array_repeat("r", 1000).alias("r")))
    expect(GUARDS[1][0], lambda: load(full), "the page limit is 1000")
    other = f"{landing}/other"
    held.select(F.to_json(F.struct(F.col("r").alias("another_name")))).write.text(other)
    expect(GUARDS[2][0], lambda: load(other), "response without")
    expect(GUARDS[3][0], lambda: load(damaged("field", lambda r: r.dropFields("quadrimestre"))), "required field(s) quadrimestre")
    null = lambda r: r.withField("competencia", F.lit(None).cast("int"))
    expect(GUARDS[4][0], lambda: load(damaged("value", null)), "no value for competencia")
    expect(GUARDS[5][0], lambda: load(answers("outside", held), named[:1]), "outside the named partitions")
    teams = lambda: ingest_file(spark, landing, root, TEAMS, "rj", 2025, 1)
    expect(GUARDS[6][0], teams, "EPRJ2501")
    beside = shared_folder(spark, "part")
    landed.team_file(spark, folder).limit(0).write.parquet(beside)  # no rows: one file
    file = next(n for n in storage.names(spark, beside) if n.endswith(".parquet"))
    storage.rename(spark, f"{beside}/{file}", f"{landing}/EPRJ2501.parquet")
    expect(GUARDS[7][0], teams, "at least one expected")
    place = f"""to_json(array(named_struct('id', {id7("n_nationkey")}, 'nome', n_name,
        'microrregiao', named_struct('id', 1, 'nome', 'x'))))"""
    nations = table(spark, folder, "nation")
    nations.select(F.expr(place)).write.option("maxRecordsPerFile", 1).text(f"{landing}/places")
    into = lambda name, path: ingest_json(spark, f"{landing}/{path}", root, name, "https://x")
    expect(GUARDS[8][0], lambda: into("raw_ibge.municipios", "places"), "unresolved")
    series = f"""to_json(array(named_struct('resultados', array(named_struct('series', array(named_struct(
        'localidade', named_struct('id', cast({id7("n_nationkey")} as string), 'nome', n_name),
        'serie', cast(map() as map<string,string>))))))))"""
    nations.select(F.expr(series)).write.option("maxRecordsPerFile", 1).text(f"{landing}/series")
    expect(GUARDS[9][0], lambda: into("raw_ibge.populacao_estimada", "series"), "empty serie")
    expect(GUARDS[10][0], lambda: open_raw(spark, root)["raw_ibge.municipios"], "never written")
    stored = open_raw(spark, root)[INDICATORS].agg(
        F.count("*").alias("stored"), F.sum("numerador").cast("bigint").alias("keys")
    )
    outcome = spark.createDataFrame(outcomes, "guard string, error string")
    return outcome.select("*", stored.select("stored").scalar().alias("stored"), stored.select("keys").scalar().alias("keys"))


@query(
    "q50_population_last_record",
    f"""
select cast({id7("c_nationkey")} as int) as id_municipio, 'second' as nome_municipio, 2025 as ano_referencia,
    cast(count(*) * 2 as bigint) as populacao_estimada
from customer group by c_nationkey""",
)
def population_last_record(spark: SparkSession, folder: str) -> DataFrame:
    """Every place comes twice in one answer; the later record is stored, in the second load too."""
    counts = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    place = f"""named_struct('localidade', named_struct('id', cast({id7("c_nationkey")} as string), 'nome', '{{0}}'),
        'serie', map('2025', cast({{1}} as string)))"""
    series = lambda told, n: F.expr(place.format(told, n))
    both = counts.select("c_nationkey", series("first", "n").alias("a"), series("second", "n * 2").alias("b"))
    listed = both.agg(F.concat(F.collect_list("a"), F.collect_list("b")).alias("series"))  # one answer holds all places
    answer = F.to_json(F.array(F.struct(F.array(F.struct("series")).alias("resultados"))))
    path, root = shared_folder(spark, "answer"), shared_folder(spark, "lake")
    listed.select(answer).write.text(path)
    name = "raw_ibge.populacao_estimada"
    for _ in range(2):
        ingest_json(spark, path, root, name, "https://x")
    stored = open_raw(spark, root)[name]
    return stored.select("id_municipio", "nome_municipio", "ano_referencia", "populacao_estimada")


@query(
    "q51_interval_sweep",
    """
with spans as (
    select o_orderkey, cast(o_orderdate as date) as a, cast(o_orderdate as date) + cast(o_custkey % 60 as int) as b,
        o_custkey from orders),
days as (select distinct cast(l_shipdate as date) as d from lineitem)
select d, count(o_orderkey) as n, cast(coalesce(sum(o_orderkey), 0) as bigint) as keys, max(o_custkey) as customer
from days left join spans on d between a and b group by d""",
)
def interval_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """Days met by thousands of overlapping order spans, up to two months long."""
    spans = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("a"),
        F.expr("date_add(to_date(o_orderdate), cast(o_custkey % 60 as int))").alias("b"),
    )
    days = table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("d")).distinct()
    met = sweep_lookup(days, "d", spans, "a", "b", {"o_orderkey": "key", "o_custkey": "customer"})
    return met.groupBy("d").agg(
        F.count("key").alias("n"),
        F.coalesce(F.sum("key"), F.lit(0)).cast("long").alias("keys"),
        F.max("customer").alias("customer"),
    )


_BANDS = """
    select p_partkey, p_retailprice as a,
        p_retailprice + case when p_partkey % 10 = 0 then p_size * 20.0 else 0.0 end as b from part"""


@query(
    "q52_overlapping_ranges",
    f"""
with bands as ({_BANDS}),
placed as (select *, row_number() over (order by a, b, p_partkey) as i from bands),
met as (
    select x.p_partkey as name, x.a as low, x.b as high, y.p_partkey as with_name, y.b as with_high,
        row_number() over (partition by x.p_partkey order by y.b desc, y.p_partkey desc) as r
    from placed x join placed y on y.i < x.i and x.a <= y.b)
select name, low, high, with_name, with_high from met where r = 1""",
)
def overlapping_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Price bands, every tenth one wide: those that begin inside an earlier one, and the one that reaches farthest."""
    return overlapping(table(spark, folder, "part").selectExpr(*_band_columns()), "p_partkey", "a", "b")


def _band_columns() -> list[str]:
    return ["p_partkey", "p_retailprice as a",
            "p_retailprice + if(p_partkey % 10 = 0, p_size * 20.0D, 0.0D) as b"]


@query(
    "q53_distinct_counts_that_merge",
    """
select o_orderpriority, count(distinct o_custkey) as customers, count(distinct year(o_orderdate)) as years
from orders group by 1""",
)
def distinct_counts_that_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads, years dealt to them, each kept as bitmaps; the counts come from the bitmaps alone."""
    orders = table(spark, folder, "orders").withColumn("y", F.year("o_orderdate").cast("long"))
    path, group = shared_folder(spark, "distinct"), ["what", "o_orderpriority"]
    values = F.explode(F.create_map(F.lit("customers"), F.col("o_custkey").cast("long"), F.lit("years"), F.col("y")))
    for load in ("0", "1", "2"):
        rows = orders.filter(F.col("y") % 3 == int(load)).select("o_orderpriority", values.alias("what", "value"))
        state = distinct_state(rows, group, "value").withColumn("load", F.lit(load))
        replace_partitions(state, path, [{"load": load}])
    counts = distinct_counts(read_table(spark, path, state.schema), group, "n")
    return counts.groupBy("o_orderpriority").agg(
        *[F.max(F.when(F.col("what") == what, F.col("n"))).alias(what) for what in ("customers", "years")]
    )


@query(
    "q54_stream_of_parts",
    """
select strftime(ts, '%Y%m') as arrival, event_type, count(*) as n,
    cast(sum(cast(value as decimal(18,2)) + case when event_type = 'signup' then 0 else 1 end) as double) as total
from events group by 1, 2""",
)
def stream_of_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Three visits to a landing folder: a part of all periods, a late part, and the first part again, in another
    folder, with corrected values."""
    rows = table(spark, folder, "events").select(
        "event_id", "event_type", F.col("value").cast(MONEY).alias("v"), F.date_format("ts", "yyyyMM").alias("arrival")
    )
    landing, target = shared_folder(spark, "landing"), shared_folder(spark, "ingested")
    late = F.col("event_type") == "signup"

    def land(part: DataFrame, place: str, name: str) -> None:
        beside = shared_folder(spark, "part")
        part.repartition(1, F.lit(0)).write.parquet(beside)  # one landed file is one part
        file = next(n for n in storage.names(spark, beside) if n.endswith(".parquet"))
        part.limit(0).write.mode("append").parquet(f"{landing}/{place}")
        storage.rename(spark, f"{beside}/{file}", f"{landing}/{place}/{name}")

    def visit(state: str) -> None:
        ingest_landing_parts(spark, landing, rows.schema, target, state, "arrival")

    state = shared_folder(spark, "progress")
    land(rows.filter(~late), "first", "events-a.parquet")
    visit(state)
    land(rows.filter(late), "second", "events-b.parquet")
    visit(state)
    corrected = rows.filter(~late).withColumn("v", (F.col("v") + 1).cast(MONEY))
    land(corrected, "third", "events-a.parquet")
    visit(state)
    stored = read_table(spark, target, rows.schema)
    return comparable(stored.groupBy("arrival", "event_type").agg(F.count("*").alias("n"), F.sum("v").alias("total")))
