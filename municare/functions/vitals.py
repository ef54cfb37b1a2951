"""Composite age of the death register: unit digit followed by two digits of quantity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from municare.functions.codes import _col, label
from municare.functions.measures import to_int
from municare.functions.text import prefix, suffix

# Unit digit of the composite age and its 'not informed' codes.
AGE_UNITS = {
    "0": "minutos",
    "1": "horas",
    "2": "dias",
    "3": "meses",
    "4": "anos",
    "5": "anos_mais_de_100",
}
AGE_UNKNOWN_CODES = ("000", "999")
AGE_UNKNOWN = "nao_informado"


def age_unit(code: Column | str) -> Column:
    known = label(prefix(code, 1), AGE_UNITS, default=AGE_UNKNOWN)
    return F.when(_col(code).isin(*AGE_UNKNOWN_CODES), F.lit(AGE_UNKNOWN)).otherwise(known)


def age_value(code: Column | str, strict: bool = True) -> Column:
    """Quantity in the unit; the '5' unit keeps its two digits, 100 is not added."""
    return F.when(~_col(code).isin(*AGE_UNKNOWN_CODES), to_int(suffix(code, 2), strict))
