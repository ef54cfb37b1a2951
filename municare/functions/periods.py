"""Month periods written as yyyyMM and day stamps in the two source layouts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from municare.functions.codes import _col
from municare.functions.text import zero_pad


def _day(
    text: Column | str, layout: str, year: int, month: int, day: int | None, strict: bool
) -> Column:
    """Date from fixed positions. Reading the digits is several times cheaper than a pattern
    parser, which is left with text of the wrong length (refused) and tolerant reads."""
    c = _col(text).cast("string")
    if not strict:
        return F.try_to_date(c, layout)

    def number(start: int, width: int) -> Column:
        return F.substring(c, start, width).cast("int")

    made = F.make_date(number(year, 4), number(month, 2), number(day, 2) if day else F.lit(1))
    return F.when(F.length(c) == len(layout), made).otherwise(F.to_date(c, layout))


def period_start(period: Column | str, strict: bool = True) -> Column:
    """First day of a yyyyMM period given as text or integer."""
    return _day(period, "yyyyMM", 1, 5, None, strict)


def day_compact(text: Column | str, strict: bool = True) -> Column:
    return _day(text, "yyyyMMdd", 1, 5, 7, strict)


def day_brazilian(text: Column | str, strict: bool = True) -> Column:
    return _day(text, "ddMMyyyy", 5, 3, 1, strict)


def period_year(period: Column | str) -> Column:
    return F.substring(_col(period), 1, 4).cast("int")


def period_month(period: Column | str) -> Column:
    return F.substring(_col(period), 5, 2).cast("int")


def join_period(year: Column | str, month: Column | str) -> Column:
    """yyyyMM from separate year and month fields, the month possibly one digit long."""
    return F.concat(_col(year).cast("string"), zero_pad(_col(month).cast("int"), 2))
