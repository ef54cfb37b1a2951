"""Declared checks on a table. NULL passes every check but ``not_null``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str
    values: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""
    severity: str = "error"


class QualityError(ValueError):
    """At least one check of severity ``error`` failed."""


def unique_failures(table: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row."""
    counts = table.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent and the rows that hold them. Values are counted before
    the anti-join, so a hot value crosses the shuffle once per task."""
    values = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count("*").alias("n")
    )
    known = parent.select(F.col(parent_column).alias("value")).filter("value is not null").distinct()
    return values.join(known, "value", "left_anti")


def _row_failure(check: Check) -> Column:
    column = F.col(check.column)
    if check.test == "not_null":
        return column.isNull()
    return column.isNotNull() & ~column.isin(*check.values)


def run(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """(model, column, test, severity, failures), one row per check; failures count rows for not_null,
    accepted_values and relationships, and repeated values for unique.

    Every model is read once. Its rows give one entry (number, value) for each checked or
    referenced column that has a value, and one for each row check that fails; the entries of all
    models are counted in one aggregation, whose partial counts a hot value crosses the shuffle in.
    What holds a value, child or parent, then meets at that value, with at most one count
    per column.
    """
    if not checks:
        return tables[next(iter(tables))].sparkSession.createDataFrame([], _RESULT)
    spark = tables[checks[0].model].sparkSession
    numbers: dict[tuple[str, str], int] = {}  # columns whose values are counted
    rules: list[tuple] = []
    entries: dict[str, list[Column]] = {}

    def number(model: str, column: str, like: T.DataType | None = None) -> int:
        """Number of a column. A child is counted in the type of its parent, so that equal values
        of other types meet."""
        key = (model, column, like.simpleString() if like else "")
        if key not in numbers:
            numbers[key] = len(numbers) + 1
            entry = F.struct(F.lit(numbers[key]).alias("no"), _as_text(tables[model], column, like).alias("value"))
            entries.setdefault(model, []).append(F.when(F.col(f"`{column}`").isNotNull(), entry))
        return numbers[key]

    for place, c in enumerate(checks):
        above = None
        if c.test == "unique":
            no = number(c.model, c.column)
        elif c.test == "relationships":
            above = number(c.parent, c.parent_column)
            kind = tables[c.parent].schema[c.parent_column].dataType
            no = number(c.model, c.column, None if kind == tables[c.model].schema[c.column].dataType else kind)
        else:
            no = -place - 1
            failed = F.struct(F.lit(no).alias("no"), F.lit("").alias("value"))
            entries.setdefault(c.model, []).append(F.when(_row_failure(c), failed))
        rules.append((place, c.model, c.column, c.test, c.severity, no, above))

    counts = {model for model, _, _ in numbers}
    found = _union([_entries(tables[model], asked, model in counts) for model, asked in entries.items()])
    counted = found.groupBy("no", "value").agg(F.count(F.lit(1)).alias("n"))
    # The same rows again, by value: no more than one per column and value is left of any table.
    at_value = counted.groupBy("value").agg(F.map_from_entries(F.collect_list(F.struct("no", "n"))).alias("held"))
    held = at_value.select(F.col("held").alias("all"), F.explode("held").alias("no", "n"))
    asked = spark.createDataFrame(rules, _RULES)
    hit = held.join(F.broadcast(asked), "no")  # one row per declared check
    bad = (
        F.when(F.col("test") == "unique", (F.col("n") > 1).cast("long"))
        .when(F.col("above").isNotNull(), F.when(~F.map_contains_key("all", F.coalesce("above", F.lit(0))), F.col("n")))
        .otherwise(F.col("n"))
    )
    failures = hit.groupBy("place").agg(F.sum(bad).alias("failures"))
    return asked.join(F.broadcast(failures), "place", "left").select(
        "model", "column", "test", "severity", F.coalesce("failures", F.lit(0)).cast("long").alias("failures")
    )


_RESULT = "model string, column string, test string, severity string, failures long"
_RULES = "place int, model string, column string, test string, severity string, no int, above int"


def _entries(table: DataFrame, asked: Sequence[Column], counts: bool) -> DataFrame:
    """(no, value) of every entry that is not null. What has row checks only is asked for the rows that fail
    one. The entries are compared with null after they are rows, in compiled code, which a filter of the array is not."""
    if not counts:
        table = table.filter(reduce(lambda a, b: a | b, [e.isNotNull() for e in asked]))
    return table.select(F.inline(F.array(*asked))).filter("no is not null")


def _as_text(table: DataFrame, column: str, like: T.DataType | None) -> Column:
    """The value as text, the same for equal values; in the type ``like`` where it can be read so."""
    value = F.col(f"`{column}`")
    if isinstance(table.schema[column].dataType, T.BinaryType):
        return F.hex(value)
    plain = value.cast("string")
    return plain if like is None else F.coalesce(value.try_cast(like).cast("string"), plain)


def _union(parts: list[DataFrame]) -> DataFrame:
    """Union in pairs: a chain would be analysed again for every part added."""
    while len(parts) > 1:
        paired = [a.unionByName(b) for a, b in zip(parts[::2], parts[1::2])]
        parts = paired + parts[2 * len(paired) :]
    return parts[0]


def enforce(results: DataFrame) -> None:
    """Raise when a check of severity ``error`` failed; warnings pass."""
    bad = results.filter("severity = 'error' and failures > 0").orderBy("model", "column").collect()
    if bad:
        told = "; ".join(f"{r['model']}.{r['column']} {r['test']}: {r['failures']}" for r in bad)
        raise QualityError(told)
