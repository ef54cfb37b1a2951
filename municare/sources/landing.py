"""Find landed files and read them with their name attached.

Files arrive decoded (Parquet, CSV or JSON); fetching and decoding them is not done here.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from municare import storage
from municare.sources.validate import EmptySource, must, watch_answers

SOURCE_FILE = "_source_file"
# Place of a record in its file; settles which of two equally new records came last.
POSITION = "_position"


def _position(row: Column, *within: Column) -> Column:
    """Blocks of a file by their start, rows within."""
    start = F.col("_metadata.file_block_start")
    return F.struct(*within, start.alias("block"), row.alias("row"))


def monthly_prefix(group: str, uf: str, year: int, month: int) -> str:
    """``PA, rj, 2025, 12`` -> ``PARJ2512``."""
    return f"{group}{uf.upper()}{year % 100:02d}{month:02d}"


def annual_prefix(group: str, uf: str, year: int) -> str:
    """``DO, rj, 2024`` -> ``DORJ2024``."""
    return f"{group}{uf.upper()}{year:04d}"


def find_parts(spark: SparkSession, folder: str, prefix: str, extension: str = "parquet") -> list[str]:
    """All parts of one landed file, sorted: the bare name or a one-letter suffix, in any
    case; files or folders of files. No part at all is an error."""
    wanted = re.compile(rf"{re.escape(prefix)}[a-z]?\.{re.escape(extension)}", re.IGNORECASE)
    parts = [n for n in storage.names(spark, folder) if wanted.fullmatch(n)]
    if not parts:
        raise EmptySource(f"no file {prefix}[a-z].{extension} in {folder}")
    return [f"{folder.rstrip('/')}/{n}" for n in parts]


def read_parts(spark: SparkSession, paths: list[str], extension: str = "parquet") -> DataFrame:
    """Rows of all parts, each with the name of its part and its place in it. A part is a file or, where
    several tasks wrote it, a folder of files, whose order is that of their names. CSV columns are read as text."""
    reader = spark.read
    if extension == "csv":
        rows = reader.option("header", "true").option("inferSchema", "false").csv(paths)
        rows = rows.na.fill("")  # an empty field is an empty text
    else:
        rows = reader.format(extension).load(paths)
    # A task reads a block from front to back, which the generated number follows.
    file = part = F.col("_metadata.file_name")
    folders = {p.rstrip("/").rsplit("/", 1)[1]: storage.folder_uri(spark, p) for p in paths}
    folders = {name: uri for name, uri in folders.items() if uri}
    for name, uri in folders.items():
        part = F.when(F.contains("_metadata.file_path", F.lit(uri)), F.lit(name)).otherwise(part)
    place = _position(F.monotonically_increasing_id(), *([file.alias("file")] if folders else []))
    return rows.withColumns({SOURCE_FILE: part, POSITION: place})


def read_records(
    spark: SparkSession, path: str, layout: str = "lines", envelope: str | None = None
) -> DataFrame:
    """JSON records as text plus a key/value map, which tells an absent key from a null one.

    ``layout`` is 'lines' (one record per line), 'array' (one response per file, a list of
    records) or 'envelope' (one response per file, the records under the key ``envelope``).
    A response is one page of the provider and so bounded by its page limit.
    """
    whole = layout != "lines"
    text = spark.read.text(path, wholetext=whole).select(
        F.col("value"),
        F.col("_metadata.file_name").alias(SOURCE_FILE),
        _position(F.monotonically_increasing_id()).alias(POSITION),
    )
    return records_from_text(text.filter(F.trim("value") != ""), layout, envelope)


def records_from_text(text: DataFrame, layout: str = "lines", envelope: str | None = None) -> DataFrame:
    """The same, from a DataFrame (value, _source_file) of JSON documents."""
    told_place = POSITION in text.columns
    if layout == "lines":
        records = text.withColumnRenamed("value", "record")
    else:
        records = answer_records(answers_from_text(text, layout, envelope))
    kept = [SOURCE_FILE, POSITION] if told_place else [SOURCE_FILE]
    return records.select(
        "record", F.from_json("record", "map<string,string>").alias("fields"), *kept
    )


def answers_from_text(text: DataFrame, layout: str, envelope: str | None = None) -> DataFrame:
    """(_source_file, records): the records of each answer as texts, from one parse of the answer. An
    answer without its envelope stops the job."""
    if layout == "envelope":
        told = F.concat(F.col(SOURCE_FILE), F.lit(f": response without '{envelope}'"))
        records = must(F.from_json("value", f"struct<`{envelope}`: array<string>>")[envelope], told)
    else:
        records = F.from_json("value", "array<string>")
    return text.select(SOURCE_FILE, records.alias("records"))


def answer_records(answers: DataFrame) -> DataFrame:
    """(record, _source_file, _position) of answers."""
    place = F.struct(F.lit(0).cast("long").alias("block"), F.col("at").cast("long").alias("row"))
    placed = answers.select(F.posexplode("records").alias("at", "record"), SOURCE_FILE)
    return placed.select("record", SOURCE_FILE, place.alias(POSITION))


def watched_records(
    spark: SparkSession, path: str, layout: str, envelope: str | None, limit: int | None, source: str
) -> tuple[DataFrame, Callable[[], None]]:
    """Records of saved answers as ``read_records`` gives them, and the guard that looks at the answers
    after the job which stored them: every answer is read and parsed once."""
    text = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias(SOURCE_FILE))
    answers = answers_from_text(text.filter(F.trim("value") != ""), layout, envelope)
    answers, guard = watch_answers(answers, F.size("records"), SOURCE_FILE, limit, source)
    records = answer_records(answers)
    return records.select("record", F.from_json("record", "map<string,string>").alias("fields"), SOURCE_FILE, POSITION), guard
