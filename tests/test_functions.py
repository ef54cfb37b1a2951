import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from municare import functions as fn


def values(spark, kind, inputs, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def test_label_without_and_with_default(spark):
    codes = ["1", "3", "9", None]
    assert values(spark, "string", codes, fn.label("x", {"1": "a", "3": "b"})) == ["a", "b", None, None]
    assert values(spark, "string", codes, fn.label("x", {"1": "a"}, "z")) == ["a", "z", "z", "z"]


def test_flag_knows_two_codes_only(spark):
    assert values(spark, "string", ["1", "0", "2", None], fn.flag("x", "1", "0")) == [True, False, None, None]


def test_sentinel_and_blank(spark):
    ended = fn.sentinel_status("x", "900001", "ativa", "desativada")
    assert values(spark, "string", ["900001", "202301", None], ended) == ["ativa", "desativada", "desativada"]
    assert values(spark, "string", ["", "7"], fn.blank_to_null("x")) == [None, "7"]


def test_zero_pad_never_truncates(spark):
    assert values(spark, "long", [33979, 1082493, 123456789], fn.zero_pad("x", 7)) == [
        "0033979", "1082493", "123456789",
    ]


def test_text_helpers(spark):
    assert values(spark, "string", ["J15", "J158", None], fn.complete_category("x")) == ["J150", "J158", None]
    assert values(spark, "string", ["12.345/0001-6"], fn.digits_only("x")) == ["1234500016"]
    assert values(spark, "string", ["a", None], fn.joined(" - ", "x", F.lit("b"))) == ["a - b", None]
    assert values(spark, "int", [3304557], fn.prefix("x", 6)) == ["330455"]


@pytest.mark.parametrize("strict", [True, False])
def test_dates_in_three_layouts(spark, strict):
    assert values(spark, "string", ["202502", None], fn.period_start("x", strict)) == [dt.date(2025, 2, 1), None]
    assert values(spark, "int", [202512], fn.period_start("x", strict)) == [dt.date(2025, 12, 1)]
    assert values(spark, "string", ["20240229"], fn.day_compact("x", strict)) == [dt.date(2024, 2, 29)]
    assert values(spark, "string", ["29022024"], fn.day_brazilian("x", strict)) == [dt.date(2024, 2, 29)]


@pytest.mark.parametrize("text", ["30022024", "", "2902202", "ab022024", "290220240"])
def test_unreadable_day_stops_strict_and_is_null_when_tolerant(spark, text):
    with pytest.raises(Exception):
        values(spark, "string", [text], fn.day_brazilian("x"))
    assert values(spark, "string", [text], fn.day_brazilian("x", strict=False)) == [None]


@pytest.mark.parametrize("text", ["202513", "2025", "20251"])
def test_unreadable_period(spark, text):
    with pytest.raises(Exception):
        values(spark, "string", [text], fn.period_start("x"))
    assert values(spark, "string", [text], fn.period_start("x", strict=False)) == [None]


def test_period_parts(spark):
    assert values(spark, "string", ["202507"], fn.period_year("x")) == [2025]
    assert values(spark, "string", ["202507"], fn.period_month("x")) == [7]
    assert values(spark, "string", ["3", "12"], fn.join_period(F.lit("2025"), "x")) == ["202503", "202512"]


def test_casts(spark):
    with pytest.raises(Exception):
        values(spark, "string", [""], fn.to_int("x"))
    assert values(spark, "string", ["", "12"], fn.to_int("x", strict=False)) == [None, 12]
    lost = fn.unreadable("x", fn.to_int("x", strict=False))
    assert values(spark, "string", ["", "12", None], lost) == [True, False, False]
    assert values(spark, "string", ["0.63"], fn.to_money("x")) == [Decimal("0.63")]


def test_shares_round_half_away_from_zero(spark):
    assert values(spark, "int", [1, 0, None], fn.percent("x", F.lit(16))) == [
        Decimal("6.3"), Decimal("0.0"), None,
    ]
    assert values(spark, "int", [-1], fn.percent("x", F.lit(16))) == [Decimal("-6.3")]
    assert values(spark, "int", [5], fn.percent("x", F.lit(0))) == [None]
    assert values(spark, "int", [7], fn.per_capita("x", F.lit(3000), 10_000, 2)) == [Decimal("23.33")]


def test_signs(spark):
    kinds = ["debito", "credito", None]
    assert values(spark, "string", kinds, fn.signed(F.lit(5), "x", "debito")) == [-5, 5, 5]
    assert values(spark, "int", [1, 0, -1, None], fn.sign_label("x", "recurso", "estorno")) == [
        "recurso", "recurso", "estorno", "estorno",
    ]


def test_band_edges_and_missing_thresholds(spark):
    def status(measures, upper, lower):
        upper, lower = (F.lit(v).cast("int") for v in (upper, lower))
        return values(spark, "int", measures, fn.band("x", upper, lower, ("ok", "mid", "low")))

    assert status([80, 79, 40, 39, None], 80, 40) == ["ok", "mid", "mid", "low", None]
    assert status([90, None], None, None) == ["low", None]
    assert status([50], None, 40) == ["mid"]


def test_composite_age(spark):
    codes = ["000", "999", "464", "500", "215", "315", "115", "015", "777", None]
    assert values(spark, "string", codes, fn.age_unit("x")) == [
        "nao_informado", "nao_informado", "anos", "anos_mais_de_100", "dias", "meses", "horas",
        "minutos", "nao_informado", "nao_informado",
    ]
    assert values(spark, "string", codes, fn.age_value("x")) == [None, None, 64, 0, 15, 15, 15, 15, 77, None]


def test_surrogate_key_needs_every_part(spark):
    key = hashlib.md5(b"r-a").hexdigest()
    assert values(spark, "string", ["a", None], fn.surrogate_key(F.lit("r"), "x")) == [key, None]


def test_conditional_aggregates(spark):
    rows = spark.createDataFrame([(1, 5), (2, 7), (2, None)], "k int, x int")
    got = rows.agg(
        fn.count_where(F.col("k") == 2), fn.sum_where("x", F.col("k") == 2), fn.sum_where("x", F.col("k") == 3)
    ).first()
    assert tuple(got) == (2, 7, None)
