"""Checks that stop a load before anything is written."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class SourceError(ValueError):
    """A landed source breaks its contract."""


class MissingField(SourceError):
    """A required field is absent from at least one record."""


class MissingValue(SourceError):
    """Records lack a value that their table must hold."""


class EmptySource(SourceError):
    """No record where at least one was expected."""


class PageLimitReached(SourceError):
    """A response holds as many records as its page limit, so more may exist."""


def require_columns(rows: DataFrame, required: Sequence[str], source: str) -> DataFrame:
    """Columnar files: a field is present for every row or for none."""
    absent = [c for c in required if c not in rows.columns]
    if absent:
        raise MissingField(f"{source}: required field(s) {', '.join(absent)} not in the file")
    return rows


def field_audit(records: DataFrame, required: Sequence[str], fields: str = "fields") -> DataFrame:
    """Rows lacking each required key: (field, missing, example). Presence is checked, not
    null-ness. One pass over the records whatever the number of fields."""
    gaps = [
        F.struct(
            F.lit(name).alias("field"),
            F.coalesce(F.count_if(_lacks(fields, name)), F.lit(0)).alias("missing"),
            F.max(F.when(_lacks(fields, name), F.to_json(F.col(fields)))).alias("example"),
        )
        for name in required
    ]
    return records.agg(F.array(*gaps).alias("gaps")).select(F.inline("gaps"))


def _lacks(fields: str, name: str) -> Column:
    return F.col(fields).isNull() | ~F.map_contains_key(F.col(fields), name)


def value_audit(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """Records without a value in a column that must hold one: (column, missing), in one pass."""
    gaps = [
        F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("missing")) for c in required
    ]
    return rows.agg(F.array(*gaps).alias("gaps")).select(F.inline("gaps")).filter("missing > 0")


def refuse(rows: DataFrame, bad: Column, message: Column | str) -> DataFrame:
    """Stop the job at the first bad row. The check rides on the pass that uses the rows, and
    the sinks commit nothing of a job that failed."""
    text = F.lit(message) if isinstance(message, str) else message
    stop = F.raise_error(text).cast("boolean")
    return rows.filter(F.when(bad, stop).otherwise(F.lit(True)))


def must(value: Column, message: Column | str) -> Column:
    """The value, or a stopped job where it is NULL."""
    return F.coalesce(value, F.raise_error(F.lit(message) if isinstance(message, str) else message))


def require_fields(records: DataFrame, required: Sequence[str], source: str) -> DataFrame:
    """Stop when a record lacks a required key; ``field_audit`` counts all such records. The
    check sits in the key/value column itself, so every record is parsed once."""
    keys = F.coalesce(F.map_keys("fields"), F.array())
    absent = F.array_except(F.array(*[F.lit(f) for f in required]), keys)
    told = F.concat(
        F.lit(f"{source}: required field(s) "),
        F.array_join(absent, ", "),
        F.lit(" absent in "),
        F.coalesce(F.col("record"), F.lit("an empty record")),
    )
    return records.withColumn("fields", must(F.when(F.size(absent) == 0, F.col("fields")), told))


def require_rows(rows: DataFrame, source: str) -> DataFrame:
    if rows.isEmpty():
        raise EmptySource(f"{source}: no records, at least one expected")
    return rows


def _observed(seen: Observation, rows: DataFrame, told: Sequence[Column]) -> dict:
    """What a job observed. Where Spark found out on the way that nothing comes out of it, it drops the
    rest of the plan and the figures with it; then they are counted by themselves."""
    try:
        found = seen.get
    except Py4JJavaError:
        found = None
    return found or rows.agg(*told).first().asDict()


def watch_rows(rows: DataFrame, source: str) -> tuple[DataFrame, Callable[[], None]]:
    """The rows, counted by whatever job uses them, and a guard to call once it is done: no row at all
    stops the load."""
    seen, told = Observation(), [F.count(F.lit(1)).alias("rows")]
    counted = rows.observe(seen, *told)

    def guard() -> None:
        if not _observed(seen, rows, told)["rows"]:
            raise EmptySource(f"{source}: no records, at least one expected")

    return counted, guard


def watch_values(rows: DataFrame, required: Sequence[str], source: str) -> tuple[DataFrame, Callable[[], None]]:
    """The rows, and a guard to call once the job that uses them is done: values missing in a required
    column stop the load. The counts ride on that job, like those of ``value_audit``."""
    if not required:
        return rows, lambda: None
    seen = Observation()
    told = [F.count_if(F.col(c).isNull()).alias(c) for c in required]
    counted = rows.observe(seen, *told)

    def guard() -> None:
        lacking = {c: n for c, n in _observed(seen, rows, told).items() if n}
        if lacking:
            listed = ", ".join(f"{c} ({n})" for c, n in lacking.items())
            raise MissingValue(f"{source}: no value for {listed}")

    return counted, guard


def watch_answers(
    answers: DataFrame, held: Column, file: str, limit: int | None, source: str
) -> tuple[DataFrame, Callable[[], None]]:
    """Answers (one row each, ``held`` records in it), measured by the job that uses their records, and a
    guard to call once it is done and before its rows become valid: an answer without records, no answer
    at all, or one as large as its page ``limit`` stops the load."""
    seen = Observation()
    empty = F.coalesce(held, F.lit(0)) <= 0
    told = [F.count(F.lit(1)).alias("answers"), F.min(F.when(empty, F.col(file))).alias("empty")]
    if limit is not None:
        full = F.when(held >= limit, F.struct(F.col(file).alias("file"), held.alias("held")))
        told += [F.min(full)["file"].alias("full"), F.min(full)["held"].alias("held")]
    measured = answers.observe(seen, *told)

    def guard() -> None:
        found = _observed(seen, answers, told)
        if not found["answers"]:
            raise EmptySource(f"{source}: no records, at least one expected")
        if found["empty"] is not None:
            raise EmptySource(f"{source}: {found['empty']} holds no records")
        if found.get("full") is not None:
            raise PageLimitReached(
                f"{source}: {found['full']} holds {found['held']} records, the page limit is {limit}"
            )

    return measured, guard


def reject_full_pages(rows: DataFrame, limit: int, source: str, per: str = "_source_file") -> DataFrame:
    """Raise when any single response reached its page limit."""
    full = rows.groupBy(per).count().filter(F.col("count") >= limit).orderBy(per).first()
    if full is not None:
        raise PageLimitReached(
            f"{source}: {full[per]} holds {full['count']} records, the page limit is {limit}"
        )
    return rows
