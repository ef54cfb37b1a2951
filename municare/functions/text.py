"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from municare.functions.codes import _col


def prefix(text: Column | str, n: int) -> Column:
    return F.left(_col(text).cast("string"), F.lit(n))


def suffix(text: Column | str, n: int) -> Column:
    return F.right(_col(text).cast("string"), F.lit(n))


def zero_pad(value: Column | str, width: int) -> Column:
    """Left zeros up to ``width``; longer text is kept whole (lpad alone would cut it)."""
    text = _col(value).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def complete_category(code: Column | str, short: int = 3) -> Column:
    """Append the missing subcategory digit of a bare category code."""
    text = _col(code)
    return F.when(F.length(text) == short, F.concat(text, F.lit("0"))).otherwise(text)


def digits_only(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), "[^0-9]", "")


def joined(separator: str, *parts: Column | str) -> Column:
    """Concatenation in which one NULL part makes the result NULL."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(separator))
        pieces.append(_col(part).cast("string"))
    return F.concat(*pieces)


def surrogate_key(*parts: Column | str) -> Column:
    """md5 over the dash-joined parts."""
    return F.md5(joined("-", *parts))
