"""The operators one by one on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municare.catalog.landed import code6, id7
from municare.catalog.models import rounded, seed_sql
from municare.catalog.registry import comparable, query, table
from municare.functions import (
    age_unit,
    age_value,
    band,
    blank_to_null,
    complete_category,
    count_where,
    day_brazilian,
    day_compact,
    digits_only,
    flag,
    is_code,
    join_period,
    joined,
    label,
    per_capita,
    percent,
    period_month,
    period_start,
    period_year,
    prefix,
    sentinel_status,
    sign_label,
    signed,
    suffix,
    sum_where,
    surrogate_key,
    to_int,
    to_money,
    unreadable,
    zero_pad,
)
from municare.operators import (
    aggregate_then_label,
    bounded,
    federate_rules,
    keep_scope,
    label_pair,
    latest_per_key,
    ledger_entries,
    left_lookup,
    membership_flag,
    presence_status,
    range_lookup,
    role_lookup,
    rule,
    union_ledgers,
)
from municare.sources.lookups import read_seed

MONEY = "decimal(18,2)"


def _values(spark: SparkSession, sql: str) -> DataFrame:
    """An inline relation of a handful of rows."""
    return F.broadcast(spark.sql(f"select * from {sql}"))


@query(
    "q01_code_bridge",
    f"""
select {id7("n_nationkey")} as id_municipio, {code6("n_nationkey")} as cod_municipio_ibge6,
    n_name as nome from nation""",
)
def code_bridge(spark: SparkSession, folder: str) -> DataFrame:
    places = table(spark, folder, "nation").selectExpr(
        f"{id7('n_nationkey')} as id_municipio", "n_name as nome"
    )
    return places.withColumn("cod_municipio_ibge6", prefix("id_municipio", 6))


@query(
    "q02_role_playing_join",
    """
select sn.n_name as supplier_place, cn.n_name as customer_place, count(*) as lines,
    cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join supplier on l_suppkey = s_suppkey
    left join nation sn on s_nationkey = sn.n_nationkey
    left join nation cn on c_nationkey = cn.n_nationkey
group by 1, 2""",
)
def role_playing_join(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and orders get their nation first, by counted broadcasts where these fit, and
    meet once on the order; the pair of nations is summed before its rows are shuffled."""
    customers = bounded(table(spark, folder, "customer").select("c_custkey", "c_nationkey"))
    suppliers = bounded(table(spark, folder, "supplier").select("s_suppkey", "s_nationkey"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    orders = orders.join(customers, F.expr("o_custkey = c_custkey")).select("o_orderkey", "c_nationkey")
    lines = table(spark, folder, "lineitem").join(suppliers, F.expr("l_suppkey = s_suppkey"))
    facts = lines.join(orders, F.expr("l_orderkey = o_orderkey"))
    by_place = facts.groupBy("s_nationkey", "c_nationkey").agg(
        F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )
    nations = bounded(table(spark, folder, "nation"))
    roles = {"s_nationkey": "supplier_place", "c_nationkey": "customer_place"}
    placed = role_lookup(by_place, nations, "n_nationkey", "n_name", roles)
    return placed.select("supplier_place", "customer_place", "lines", "quantity")


@query(
    "q03_grouped_production",
    """
select s_nationkey as place, cast(date_trunc('month', l_shipdate) as date) as period,
    left(p_type, 2) as code, case left(p_type, 2) when 'EC' then 'economy' when 'SM' then 'small'
        when 'ME' then 'medium' when 'LA' then 'large' when 'PR' then 'promo' end as label,
    count(*) as lines, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity,
    cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as amount
from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
where s_nationkey is not null group by 1, 2, 3, 4""",
)
def grouped_production(spark: SparkSession, folder: str) -> DataFrame:
    """Production by place, month and code prefix; the prefix ST has no label.

    Lines collapse to supplier, month and prefix before the supplier is looked up, and the
    label comes last. Parts beyond the broadcast check are joined by a shuffle of two plain
    scans, where AQE splits a part that owns most lines.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_partkey",
        "l_suppkey",
        F.trunc("l_shipdate", "month").alias("period"),
        F.col("l_quantity").cast("bigint").alias("q"),
        F.col("l_extendedprice").cast(MONEY).alias("a"),
    )
    parts = table(spark, folder, "part").select("p_partkey", prefix("p_type", 2).alias("code"))
    suppliers = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("place"))
    by_supplier = (
        lines.join(bounded(parts), F.expr("l_partkey = p_partkey"))
        .groupBy("l_suppkey", "period", "code")
        .agg(F.count("*").alias("n"), F.sum("q").alias("q"), F.sum("a").cast("decimal(28,2)").alias("a"))
    )
    rows = by_supplier.join(bounded(suppliers), F.expr("l_suppkey = s_suppkey")).filter(
        F.col("place").isNotNull()
    )
    labels = _values(
        spark,
        "values ('EC', 'economy'), ('SM', 'small'), ('ME', 'medium'), ('LA', 'large'),"
        " ('PR', 'promo') as t(k, label)",
    )
    out = aggregate_then_label(
        rows,
        ["place", "period", "code"],
        [F.sum("n").alias("lines"), F.sum("q").alias("quantity"), F.sum("a").alias("amount")],
        "code",
        labels,
        "k",
        {"label": "label"},
    )
    return comparable(out)


RANGE_CODE = """substr('ABEGIJKLNOP', cast(o_orderkey % 11 as int) + 1, 1)
    || lpad(cast(o_orderkey * 7 % 1000 as {text}), 3, '0')"""


@query(
    "q04_range_lookup_distinct",
    f"""
select grupo_icsap, grupo_icsap is not null as sensitive, count(*) as n
from orders left join {seed_sql("seed_icsap_cid10")}
    on {RANGE_CODE.format(text="varchar")} between cid_inicio and cid_fim group by 1, 2""",
)
def range_lookup_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Each distinct code is resolved once, with the number of rows it stands for."""
    codes = (
        table(spark, folder, "orders")
        .groupBy(F.expr(RANGE_CODE.format(text="string")).alias("code"))
        .agg(F.count("*").alias("rows"))
    )
    found = range_lookup(
        codes.withColumn("code", complete_category("code")),
        "code",
        read_seed(spark, "seed_icsap_cid10"),
        "cid_inicio",
        "cid_fim",
        {"grupo_icsap": "grupo_icsap"},
    )
    sensitive = F.col("grupo_icsap").isNotNull().alias("sensitive")
    return found.groupBy("grupo_icsap", sensitive).agg(F.sum("rows").alias("n"))


@query(
    "q05_share_by_area_year",
    f"""
with counted as (
    select c_nationkey, cast(year(o_orderdate) as int) as y, count(*) as n,
        count(*) filter (where o_orderstatus = 'F') as f
    from orders join customer on o_custkey = c_custkey group by 1, 2)
select c_nationkey as area, y as year, n as total, f as finished,
    {rounded("f", "n", 100, 1)} as share from counted""",
)
def share_by_area_year(spark: SparkSession, folder: str) -> DataFrame:
    per_customer = (
        table(spark, folder, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(F.count("*").alias("n"), count_where(F.col("o_orderstatus") == "F").alias("f"))
    )
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("area"))
    rows = per_customer.join(customers, F.expr("o_custkey = c_custkey"))
    totals = rows.groupBy("area", "year").agg(
        F.sum("n").alias("total"), F.sum("f").alias("finished")
    )
    return comparable(totals.withColumn("share", percent("finished", "total")))


@query(
    "q06_latest_per_key",
    """
select o_custkey, o_orderkey, o_orderstatus, cast(o_orderdate as date) as o_orderdate from (
    select *, row_number() over (partition by o_custkey order by o_orderdate desc nulls first,
        o_orderkey desc) as r from orders) where r = 1""",
)
def latest_order(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date")
    )
    return latest_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "q07_presence_status",
    """
with months as (select distinct o_custkey as k, cast(date_trunc('month', o_orderdate) as date) as d
    from orders)
select k, d as period, min(d) over (partition by k) as first, max(d) over (partition by k) as last,
    case when d < max(d) over (partition by k) then 'historico'
        when max(d) over (partition by k) = max(d) over () then 'ativo'
        else 'possivelmente_encerrado' end as status
from months""",
)
def presence(spark: SparkSession, folder: str) -> DataFrame:
    months = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("k"), F.trunc("o_orderdate", "month").alias("period")
    )
    return presence_status(months.distinct(), "k", "period", "first", "last", "status")


SIGNED_LEDGER = """
select 'events' as fonte, cast(user_id as int) as id_municipio, cast(ts as date) as data_referencia,
    cast(year(ts) as int) as ano, event_type as tipo_lancamento, props as descricao_origem,
    case when event_type = 'error' then -cast(value as decimal(18,2))
        else cast(value as decimal(18,2)) end as valor
from events
union all
select 'accounts', cast(c_nationkey as int), cast(null as date), 2024,
    case when c_acctbal >= 0 then 'recurso' else 'estorno' end, c_mktsegment || ' - ' || c_name,
    cast(c_acctbal as decimal(18,2))
from customer"""


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("amount", F.col("value").cast(MONEY))
    accounts = table(spark, folder, "customer").withColumn("amount", F.col("c_acctbal").cast(MONEY))
    return union_ledgers(
        ledger_entries(
            events,
            "events",
            id_municipio=F.col("user_id").cast("int"),
            data_referencia=F.to_date("ts"),
            ano=F.year("ts"),
            tipo_lancamento=F.col("event_type"),
            descricao_origem=F.col("props"),
            valor=signed("amount", "event_type", "error"),
        ),
        ledger_entries(
            accounts,
            "accounts",
            id_municipio=F.col("c_nationkey").cast("int"),
            data_referencia=F.lit(None).cast("date"),
            ano=F.lit(2024),
            tipo_lancamento=sign_label("amount", "recurso", "estorno"),
            descricao_origem=joined(" - ", "c_mktsegment", "c_name"),
            valor=F.col("amount"),
        ),
    )


@query(
    "q08_signed_ledger_union",
    f"select * replace (cast(valor as double) as valor) from ({SIGNED_LEDGER})",
)
def signed_ledger_union(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_ledger(spark, folder))


@query(
    "q09_negative_balance_alert",
    f"""
select md5('saldo-' || id_municipio || '-' || ano || '-' || tipo_lancamento) as id,
    id_municipio, ano, 'Saldo ' || sum(valor) || ' em ' || ano as told
from ({SIGNED_LEDGER}) group by id_municipio, ano, tipo_lancamento having sum(valor) < 0""",
)
def negative_balance(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["id_municipio", "ano", "tipo_lancamento"]
    balance = _ledger(spark, folder).groupBy(*keys).agg(F.sum("valor").alias("v"))
    told = F.concat(F.lit("Saldo "), F.round("v", 2).cast("string"), F.lit(" em "), F.col("ano"))
    return balance.filter("v < 0").select(
        surrogate_key(F.lit("saldo"), *keys).alias("id"), "id_municipio", "ano", told.alias("told")
    )


@query(
    "q10_rule_alert_union",
    """
with debts as (select c_nationkey as n, count(*) as c from customer where c_acctbal < 0 group by 1),
    failed as (select c_nationkey as n, cast(year(o_orderdate) as int) as y, count(*) as c
        from orders join customer on c_custkey = o_custkey where o_orderstatus = 'P' group by 1, 2),
    found as (
        select 'debt' as code, 'accounts below zero' as what, 'media' as severity, n,
            'all' as period, c || ' account(s)' as told from debts
        union all select 'pending', 'orders pending', 'alta', n, cast(y as varchar), c || ' order(s)'
            from failed)
select md5(code || '-' || n || '-' || period) as id_alerta, code as codigo_regra,
    what as descricao_regra, severity as severidade, 'municipio' as tipo_entidade,
    n as id_municipio, n_name as nome_municipio, period as periodo_referencia, told as evidencia,
    'ativo' as status
from found left join nation on n_nationkey = n""",
)
def rule_alert_union(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    place = F.col("c_nationkey").alias("id_municipio")
    debts = customers.filter("c_acctbal < 0").groupBy(place).agg(F.count("*").alias("c"))
    pending = (
        table(spark, folder, "orders")
        .filter("o_orderstatus = 'P'")
        .groupBy("o_custkey", F.year("o_orderdate").alias("y"))
        .agg(F.count("*").alias("c"))
        .join(customers.select("c_custkey", "c_nationkey"), F.expr("o_custkey = c_custkey"))
        .groupBy(place, "y")
        .agg(F.sum("c").alias("c"))
    )
    names = bounded(
        table(spark, folder, "nation").selectExpr("n_nationkey as id_municipio", "n_name as nome_municipio")
    )
    count = F.col("c").cast("string")
    return federate_rules(
        [
            rule(debts, "debt", "accounts below zero", "media", F.lit("all"),
                 F.concat(count, F.lit(" account(s)"))),
            rule(pending, "pending", "orders pending", "alta", F.col("y").cast("string"),
                 F.concat(count, F.lit(" order(s)"))),
        ],
        names,
    )


@query(
    "q11_self_join_applied_vs_min",
    """
with long as (select l_suppkey, cast(year(l_shipdate) as int) as y, l_returnflag as label,
    cast(sum(cast(l_quantity as bigint)) as bigint) as v from lineitem group by 1, 2, 3)
select a.l_suppkey, a.y, a.v as applied, m.v as minimum
from long a join long m on a.l_suppkey = m.l_suppkey and a.y = m.y
where a.label = 'R' and m.label = 'A' and a.v < m.v""",
)
def applied_vs_minimum(spark: SparkSession, folder: str) -> DataFrame:
    long = (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", F.year("l_shipdate").alias("y"), F.col("l_returnflag").alias("label"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("v"))
    )
    pairs = label_pair(
        long, ["l_suppkey", "y"], "label", "v", ("R", "applied"), ("A", "minimum")
    )
    return pairs.filter(F.col("applied") < F.col("minimum"))


LIMITS = """values ('STANDARD', 40, 20), ('ECONOMY', 30, 30), ('SMALL', null, 10),
    ('MEDIUM', null, null), ('PROMO', 45, 5) as t(kind, hi, lo)"""


@query(
    "q12_threshold_bands",
    f"""
select p_partkey, p_size, hi, lo, case when p_size >= hi then 'ok' when p_size >= lo then 'atencao'
    else 'critico' end as status
from part left join (select * from ({LIMITS.replace(' as t', ') as t')}) on kind = p_type""",
)
def threshold_bands(spark: SparkSession, folder: str) -> DataFrame:
    limits = _values(spark, LIMITS)
    parts = table(spark, folder, "part").select("p_partkey", "p_size", "p_type")
    rows = left_lookup(parts, limits, {"p_type": "kind"}, {"hi": "hi", "lo": "lo"})
    status = band("p_size", "hi", "lo", ("ok", "atencao", "critico"))
    return rows.select("p_partkey", "p_size", "hi", "lo", status.alias("status"))


@query(
    "q13_null_threshold_band",
    f"""
with rows as (select p_partkey, case when p_size <> 13 then p_size end as m, p_type from part)
select p_partkey, m, case when m is null then null when hi is not null and m >= hi then 'ok'
    when lo is not null and m >= lo then 'atencao' else 'critico' end as status
from rows left join (select * from ({LIMITS.replace(' as t', ') as t')}) on kind = p_type""",
)
def null_threshold_band(spark: SparkSession, folder: str) -> DataFrame:
    """Types without limits, or with a missing limit, still classify a known measure."""
    parts = table(spark, folder, "part").select(
        "p_partkey", F.nullif(F.col("p_size"), F.lit(13)).alias("m"), "p_type"
    )
    rows = left_lookup(
        parts, _values(spark, LIMITS), {"p_type": "kind"}, {"hi": "hi", "lo": "lo"}
    )
    return rows.select(
        "p_partkey", "m", band("m", "hi", "lo", ("ok", "atencao", "critico")).alias("status")
    )


@query(
    "q14_coverage_multi_grain",
    f"""
with people as (select c_nationkey as n, count(*) as people,
        count(*) filter (where c_mktsegment = 'BUILDING' and c_acctbal >= 0) as good
        from customer group by 1),
    supply as (select s_nationkey as n, count(*) as suppliers,
        cast(sum(cast(s_acctbal as decimal(18,2))) filter (where s_acctbal < 0) as double) as debt
        from supplier group by 1),
    activity as (select c_nationkey as n, max(strftime(o_orderdate, '%Y%m')) as last,
        count(*) as orders from orders join customer on c_custkey = o_custkey group by 1)
select n_name as place, r_name as area, people, coalesce(good, 0) as good,
    coalesce(suppliers, 0) as suppliers, debt, last, orders,
    {rounded("good", "people", 100, 1)} as share
from nation join region on n_regionkey = r_regionkey and r_name in ('AMERICA', 'ASIA', 'EUROPE')
    left join people on people.n = n_nationkey left join supply on supply.n = n_nationkey
    left join activity on activity.n = n_nationkey""",
)
def coverage_multi_grain(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    people = customers.groupBy("c_nationkey").agg(
        F.count("*").alias("people"),
        count_where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") >= 0)).alias("good"),
    )
    supply = table(spark, folder, "supplier").groupBy("s_nationkey").agg(
        F.count("*").alias("suppliers"),
        sum_where(F.col("s_acctbal").cast(MONEY), F.col("s_acctbal") < 0).alias("debt"),
    )
    activity = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.max(F.date_format("o_orderdate", "yyyyMM")).alias("last"), F.count("*").alias("n"))
        .join(customers.select("c_custkey", "c_nationkey"), F.expr("o_custkey = c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.max("last").alias("last"), F.sum("n").alias("orders"))
    )
    scope = table(spark, folder, "region").filter(F.col("r_name").isin("AMERICA", "ASIA", "EUROPE"))
    places = keep_scope(table(spark, folder, "nation"), scope, {"n_regionkey": "r_regionkey"})
    rows = left_lookup(places, scope, {"n_regionkey": "r_regionkey"}, {"r_name": "area"})
    rows = left_lookup(
        rows, people, {"n_nationkey": "c_nationkey"}, {"people": "people", "good": "good"}
    )
    rows = left_lookup(
        rows, supply, {"n_nationkey": "s_nationkey"}, {"suppliers": "suppliers", "debt": "debt"}
    )
    rows = left_lookup(
        rows, activity, {"n_nationkey": "c_nationkey"}, {"last": "last", "orders": "orders"}
    )
    return comparable(
        rows.select(
            F.col("n_name").alias("place"), "area", "people",
            F.coalesce("good", F.lit(0)).alias("good"),
            F.coalesce("suppliers", F.lit(0)).alias("suppliers"),
            "debt", "last", "orders", percent("good", "people").alias("share"),
        )
    )


@query(
    "q15_per_capita_membership_flag",
    f"""
with s as (select s_nationkey as k, count(*) as suppliers from supplier group by 1),
    c as (select c_nationkey as k, count(*) as people from customer group by 1)
select n_name as place, suppliers, {rounded("suppliers", "people", 10000, 2)} as per_10k,
    n_nationkey in (1, 3, 99) as reference
from nation left join s on s.k = n_nationkey left join c on c.k = n_nationkey""",
)
def per_capita_flag(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("n"))
    people = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    rows = left_lookup(
        table(spark, folder, "nation"), suppliers, {"n_nationkey": "s_nationkey"}, {"n": "suppliers"}
    )
    rows = left_lookup(rows, people, {"n_nationkey": "c_nationkey"}, {"n": "people"})
    members = _values(spark, "values (1), (3), (99) as t(k)")
    rows = membership_flag(rows, members, {"n_nationkey": "k"}, "reference")
    rate = per_capita("suppliers", "people", 10_000, 2).alias("per_10k")
    return comparable(rows.select(F.col("n_name").alias("place"), "suppliers", rate, "reference"))


@query(
    "q16_detail_listing",
    """
select o_orderkey, o_orderstatus, c_name as customer, n_name as place
from orders left join customer on c_custkey = o_custkey and c_acctbal >= 0
    join nation on n_nationkey = o_custkey % 27""",
)
def detail_listing(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_custkey", (F.col("o_custkey") % 27).alias("k")
    )
    customers = table(spark, folder, "customer").filter("c_acctbal >= 0")
    rows = left_lookup(orders, customers, {"o_custkey": "c_custkey"}, {"c_name": "customer"})
    nations = bounded(table(spark, folder, "nation").selectExpr("n_nationkey as k", "n_name as place"))
    return rows.join(nations, "k").select("o_orderkey", "o_orderstatus", "customer", "place")


@query(
    "q17_distinct_count_alert",
    """
select o_orderstatus, cast(year(o_orderdate) as int) as y,
    count(distinct o_custkey) || ' customer(s)' as told from orders group by 1, 2""",
)
def distinct_count(spark: SparkSession, folder: str) -> DataFrame:
    counted = (
        table(spark, folder, "orders")
        .groupBy("o_orderstatus", F.year("o_orderdate").alias("y"))
        .agg(F.countDistinct("o_custkey").alias("n"))
    )
    return counted.select(
        "o_orderstatus", "y", F.concat(F.col("n").cast("string"), F.lit(" customer(s)")).alias("told")
    )


@query(
    "q18_composite_code_decode",
    """
with coded as (select o_orderkey, cast(o_orderkey % 1000 as int) as c from orders)
select o_orderkey, case when c in (0, 999) or c >= 600 then 'nao_informado'
        else ['minutos', 'horas', 'dias', 'meses', 'anos', 'anos_mais_de_100'][c // 100 + 1] end as unit,
    case when c not in (0, 999) then cast(c % 100 as int) end as amount
from coded""",
)
def composite_code(spark: SparkSession, folder: str) -> DataFrame:
    coded = table(spark, folder, "orders").select(
        "o_orderkey", F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0").alias("c")
    )
    return coded.select("o_orderkey", age_unit("c").alias("unit"), age_value("c").alias("amount"))


@query(
    "q19_code_labels_default_and_null",
    """
select o_orderkey, case o_orderstatus when 'F' then 'finished' when 'O' then 'open' end as known,
    case o_orderstatus when 'F' then 'finished' else 'other' end as defaulted,
    case o_orderstatus when 'F' then true when 'O' then false end as flagged,
    case when o_orderpriority = '5-LOW' then 'low' else 'rest' end as sentinel,
    o_orderstatus = 'P' as compared
from orders""",
)
def code_labels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        label("o_orderstatus", {"F": "finished", "O": "open"}).alias("known"),
        label("o_orderstatus", {"F": "finished"}, "other").alias("defaulted"),
        flag("o_orderstatus", yes="F", no="O").alias("flagged"),
        sentinel_status("o_orderpriority", "5-LOW", "low", "rest").alias("sentinel"),
        is_code("o_orderstatus", "P").alias("compared"),
    )


@query(
    "q20_period_dates",
    """
select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as month_start,
    cast(date_trunc('month', o_orderdate) as date) as month_start_int,
    cast(o_orderdate as date) as compact, cast(o_orderdate as date) as brazilian,
    cast(year(o_orderdate) as int) as y, cast(month(o_orderdate) as int) as m,
    strftime(o_orderdate, '%Y%m') as rejoined
from orders""",
)
def period_dates(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMM").alias("p"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("c"),
        F.date_format("o_orderdate", "ddMMyyyy").alias("b"),
    )
    return texts.select(
        "o_orderkey",
        period_start("p").alias("month_start"),
        period_start(F.col("p").cast("int")).alias("month_start_int"),
        day_compact("c").alias("compact"),
        day_brazilian("b").alias("brazilian"),
        period_year("p").alias("y"),
        period_month("p").alias("m"),
        join_period(period_year("p"), period_month("p")).alias("rejoined"),
    )


@query(
    "q21_zero_pad_and_digits",
    """
select c_custkey, case when length(cast(c_custkey * 37 as varchar)) < 4
        then lpad(cast(c_custkey * 37 as varchar), 4, '0') else cast(c_custkey * 37 as varchar) end as padded,
    regexp_replace(c_name, '[^0-9]', '', 'g') as digits, right(c_name, 3) as tail,
    left(c_name, 4) as head
from customer""",
)
def pad_and_digits(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_custkey",
        zero_pad(F.col("c_custkey") * 37, 4).alias("padded"),
        digits_only("c_name").alias("digits"),
        suffix("c_name", 3).alias("tail"),
        prefix("c_name", 4).alias("head"),
    )


@query(
    "q22_safe_cast_sentinel",
    """
select p_partkey, case when p_size <> 50 then p_size end as strict_size,
    case when p_size % 5 > 0 then p_size end as tolerant_size,
    p_size % 5 = 0 as lost, cast(cast(p_retailprice as decimal(18,2)) as double) as price
from part""",
)
def safe_cast(spark: SparkSession, folder: str) -> DataFrame:
    """A sentinel becomes NULL before the strict cast; a tolerant cast loses what it cannot
    read and says so."""
    texts = table(spark, folder, "part").select(
        "p_partkey",
        F.col("p_size").cast("string").alias("s"),
        F.expr("if(p_size % 5 = 0, 'n/a', cast(p_size as string))").alias("t"),
        F.col("p_retailprice").cast(MONEY).cast("string").alias("r"),
    )
    tolerant = to_int("t", strict=False)
    return comparable(
        texts.select(
            "p_partkey",
            to_int(blank_to_null("s", "50")).alias("strict_size"),
            tolerant.alias("tolerant_size"),
            unreadable("t", tolerant).alias("lost"),
            to_money("r").alias("price"),
        )
    )
