"""Code to label, code to flag, sentinel handling."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label(code: Column | str, names: Mapping[str, str], default: str | None = None) -> Column:
    """Name of a code; codes outside the table (and NULL) give ``default``."""
    pairs = iter(names.items())
    first_code, first_name = next(pairs)
    chain = reduce(
        lambda acc, kv: acc.when(_col(code) == kv[0], F.lit(kv[1])),
        pairs,
        F.when(_col(code) == first_code, F.lit(first_name)),
    )
    return chain.otherwise(F.lit(default)) if default is not None else chain


def flag(code: Column | str, yes: str, no: str) -> Column:
    """TRUE/FALSE for the two known codes, NULL for anything else."""
    return F.when(_col(code) == yes, F.lit(True)).when(_col(code) == no, F.lit(False))


def is_code(code: Column | str, value: str | int) -> Column:
    """Plain comparison as a boolean column; NULL stays NULL."""
    return _col(code) == F.lit(value)


def sentinel_status(code: Column | str, sentinel: str, on_sentinel: str, otherwise: str) -> Column:
    """Status told by one reserved code; any other value, NULL included, is ``otherwise``."""
    return F.when(_col(code) == sentinel, F.lit(on_sentinel)).otherwise(F.lit(otherwise))


def blank_to_null(code: Column | str, blank: str = "") -> Column:
    """NULL where the source writes a reserved 'not informed' value."""
    return F.nullif(_col(code), F.lit(blank))
