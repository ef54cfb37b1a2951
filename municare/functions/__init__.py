"""Column expressions shared by the plans; every one stays inside JVM code generation."""

from municare.functions.codes import blank_to_null, flag, is_code, label, sentinel_status
from municare.functions.measures import (
    band,
    count_where,
    per_capita,
    percent,
    sign_label,
    signed,
    sum_where,
    to_int,
    to_money,
    unreadable,
)
from municare.functions.periods import (
    day_brazilian,
    day_compact,
    join_period,
    period_month,
    period_start,
    period_year,
)
from municare.functions.text import (
    complete_category,
    digits_only,
    joined,
    prefix,
    suffix,
    surrogate_key,
    zero_pad,
)
from municare.functions.vitals import age_unit, age_value

__all__ = [
    "age_unit",
    "age_value",
    "band",
    "blank_to_null",
    "complete_category",
    "count_where",
    "day_brazilian",
    "day_compact",
    "digits_only",
    "flag",
    "is_code",
    "join_period",
    "joined",
    "label",
    "per_capita",
    "percent",
    "period_month",
    "period_start",
    "period_year",
    "prefix",
    "sentinel_status",
    "sign_label",
    "signed",
    "suffix",
    "sum_where",
    "surrogate_key",
    "to_int",
    "to_money",
    "unreadable",
    "zero_pad",
]
