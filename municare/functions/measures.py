"""Numbers: casts, shares, signs, bands and conditional aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from municare.functions.codes import _col

MONEY = "decimal(18,2)"


def _cast(c: Column | str, kind: str, strict: bool) -> Column:
    return _col(c).cast(kind) if strict else _col(c).try_cast(kind)


def to_int(c: Column | str, strict: bool = True) -> Column:
    """Strict raises on unreadable text (ANSI mode); tolerant gives NULL."""
    return _cast(c, "int", strict)


def to_money(c: Column | str, strict: bool = True) -> Column:
    return _cast(c, MONEY, strict)


def unreadable(c: Column | str, parsed: Column) -> Column:
    """TRUE where a tolerant parse lost a value that was there."""
    return _col(c).isNotNull() & parsed.isNull()


def per_capita(amount: Column | str, base: Column | str, scale: int, digits: int) -> Column:
    """``scale * amount / base`` rounded half up; NULL where the base is zero."""
    top = F.lit(scale).cast("decimal(9,0)") * _col(amount).cast("decimal(18,4)")
    bottom = F.nullif(_col(base).cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)"))
    return F.round(top / bottom, digits)


def percent(part: Column | str, whole: Column | str, digits: int = 1) -> Column:
    return per_capita(part, whole, 100, digits)


def signed(amount: Column | str, kind: Column | str, negative_kind: str) -> Column:
    """Minus for one kind of entry; every other kind, NULL included, keeps its sign."""
    return F.when(_col(kind) == negative_kind, -_col(amount)).otherwise(_col(amount))


def sign_label(amount: Column | str, at_least_zero: str, below_zero: str) -> Column:
    return F.when(_col(amount) >= 0, F.lit(at_least_zero)).otherwise(F.lit(below_zero))


def band(
    measure: Column | str,
    upper: Column | str,
    lower: Column | str,
    names: tuple[str, str, str],
) -> Column:
    """Three ordered bands. A missing threshold never matches, so a known measure without
    thresholds lands in the last band; an unknown measure has no band."""
    m = _col(measure)
    return (
        F.when(m >= _col(upper), F.lit(names[0]))
        .when(m >= _col(lower), F.lit(names[1]))
        .when(m.isNotNull(), F.lit(names[2]))
    )


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(amount: Column | str, condition: Column) -> Column:
    """Sum over matching rows; NULL when none matches."""
    return F.sum(F.when(condition, _col(amount)))
