"""Parquet tables in ``<root>/<schema>/<table>``, partitioned by their replacement key.

Which files are valid says the pointer of each table (``versions``): a load writes beside what is valid
and commits once all its rows are written and checked, so a load that stops, at any point, changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from municare import storage
from municare.operators.history import latest_per_key
from municare.operators.lookup import MAX_BROADCAST_ROWS
from municare.session import narrow_scans
from municare.sinks import versions
from municare.sinks.versions import VERSION, MissingTable, Part, State, TableChanged, sweep
from municare.sources.validate import refuse

PIECE = "_piece"
HASH = "_hash"
LOADED_AT = "_loaded_at"
LOCATOR = T.StructType([T.StructField(HASH, T.LongType()), T.StructField(PIECE, T.StringType())])
ATTEMPTS = 5  # commits of an upsert that other loads came before

Guard = Callable[[], None]


def table_path(root: str, layer: str, name: str) -> str:
    """Layer and name are used exactly as given, with no prefix added."""
    return f"{root.rstrip('/')}/{layer}/{name}"


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, may_be_empty: bool = True
) -> DataFrame:
    """Read under a declared schema: partition values keep their type, columns added later
    are NULL in older files and columns no longer declared disappear. A table that was never
    written reads as empty, or is an error unless it ``may_be_empty``. Files that other tools
    wrote there are read as they are as long as there is no pointer."""
    found = versions.state(spark, path)
    if found is not None:
        return versions.read_parts(spark, path, schema, found)
    if _foreign(spark, path):
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    if not may_be_empty:
        raise MissingTable(f"{path} was never written")
    return spark.createDataFrame([], schema)


def _foreign(spark: SparkSession, path: str) -> bool:
    """Files without a pointer that no load of this module left."""
    return any(n[0] not in "._" for n in storage.names(spark, path))


def _write(rows: DataFrame, path: str, partitions: Sequence[str], gather: bool = True) -> None:
    """A new version. Gathering rebalances the rows by partition: a partition that holds
    most of them is split over several tasks and small ones share a task, so neither one
    task nor a flood of small files results. It costs a shuffle, which rows that already lie
    together by partition do without."""
    writer = (rows.hint("rebalance", *partitions) if gather else rows).write.mode("error")
    writer.partitionBy(*partitions).parquet(path)


def _named(schema: T.StructType, partitions: Sequence[Mapping[str, object]]) -> Column:
    """Whether a row lies in one of the partitions: one lookup in a set, missing values included."""
    columns = list(partitions[0])
    values = [
        F.struct(*[F.lit(p[c]).cast(schema[c].dataType).alias(c) for c in columns]) for p in partitions
    ]
    return F.struct(*[F.col(c).alias(c) for c in columns]).isin(*values)


def replace_partitions(
    batch: DataFrame,
    path: str,
    partitions: Sequence[Mapping[str, object]],
    aligned: bool = False,
    newest: Mapping[object, int | None] | None = None,
    guard: Guard | None = None,
) -> None:
    """Replace the named partitions by the batch, and nothing else. ``aligned`` says that the
    batch is read from files laid out by the same partitions and needs no shuffle; a batch
    of one partition never does.

    The partitions are named by the caller (the arrival period it fetched), never taken from
    the rows, so late rows cannot wipe another period. A named partition without rows is empty
    from the same commit on. ``guard`` is called between the write and the commit and may
    still refuse the batch. Rows and newest load time of each partition are kept with the pointer;
    ``newest`` gives the times (by the value of the one partition column) instead of the rows.
    """
    spark = batch.sparkSession
    _refuse_foreign(spark, path)
    columns = list(partitions[0])
    inside = _named(batch.schema, partitions)
    guarded = refuse(batch, ~inside, "batch holds rows outside the named partitions")
    version = versions.new_version()
    target = f"{path}/{VERSION}={version}"
    _write(guarded, target, columns, gather=not aligned and len(partitions) > 1)
    if guard is not None:
        guard()
    filled = set(versions.written_parts(spark, path, version, len(columns)))
    told = _ledger(spark, target, batch.schema, columns) if newest is None else {}
    changes: dict[str, Part | None] = {}
    for partition in partitions:
        name = _folder(partition)
        if newest is not None:
            told_newest = newest.get(partition[columns[0]])
            changes[name] = Part(version if name in filled else None, None, told_newest)
        elif name in filled:
            changes[name] = Part(version, *told.get(name, (None, None)))
        else:
            changes[name] = None
    versions.commit(spark, path, changes)


def _ledger(
    spark: SparkSession, target: str, schema: T.StructType, columns: Sequence[str]
) -> dict[str, tuple[int, int | None]]:
    """Rows and newest load time of each partition of a version that was just written, from the one
    column that holds the time; nothing for tables without it."""
    if LOADED_AT not in schema.names:
        return {}
    rows = spark.read.schema(schema).parquet(target).groupBy(*columns)
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.unix_micros(F.max(LOADED_AT)).alias("newest"))
    return {_folder({c: r[c] for c in columns}): (r["n"], r["newest"]) for r in counted.collect()}


def loads(spark: SparkSession, path: str, column: str, kind: T.DataType | None = None) -> dict[object, Part]:
    """What the pointer knows of each partition, by the value of its column. No row is read."""
    parts = (versions.state(spark, path) or State()).parts
    held = [name.split("=", 1)[1] for name in parts]
    values: list[object] = [None if v == _NO_VALUE else _unescaped(v) for v in held]
    if values and kind is not None and not isinstance(kind, T.StringType):
        typed = spark.createDataFrame([(v,) for v in values], "v string").select(F.col("v").cast(kind))
        values = [r[0] for r in typed.collect()]
    return dict(zip(values, parts.values()))


def _refuse_foreign(spark: SparkSession, path: str) -> None:
    if versions.state(spark, path) is None and any("=" in n for n in storage.names(spark, path) if n[0] not in "._"):
        raise ValueError(f"{path} holds files of another layout; load it as a new table")


_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]")


def _folder(partition: Mapping[str, object]) -> str:
    """Folder of a partition, special characters and missing values as Spark writes them."""

    def name(value: object) -> str:
        if value is None or value == "":
            return _NO_VALUE
        return _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", str(value))

    return "/".join(f"{column}={name(value)}" for column, value in partition.items())


def _unescaped(name: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), name)


def upsert(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    newest_first: Sequence[str] = ("_loaded_at", "_source_file"),
    slots: int | None = None,
    within: str | None = None,
    order_only: Sequence[str] = (),
    guard: Guard | None = None,
) -> None:
    """Upsert by natural key: the batch wins over the table, its newest version of a key wins
    within the batch, NULL keys are refused.

    The rows of a load are written once, as pieces of the table (of a size that Spark chooses, or ``slots``
    of them by key). A locator stored beside each piece holds the hashes of its keys; a later load looks its
    own keys up there and rewrites the pieces that hold one of them, without those rows; a large load gives
    these rows new pieces as they lie after the join. Pieces that hold none are neither read nor written. Where a period, ``within``, is part of the key, the periods are
    the pieces and need no locator.

    New rows and rewritten pieces become valid in one commit. When another load committed first, the
    pieces are looked up again and only those rewritten anew.

    ``order_only`` columns of the batch settle which of equally new rows came last, such as
    their place in the load, and are not stored. ``guard`` is called before the commit.
    """
    spark = batch.sparkSession
    _refuse_foreign(spark, path)
    order = [c for c in (*newest_first, *order_only) if c in batch.columns]
    unkeyed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    checked = refuse(batch, unkeyed, f"NULL in key {list(keys)}")
    latest = latest_per_key(checked, keys, order).drop(*order_only)
    columns = latest.columns
    part = within or PIECE
    loaded = versions.new_version()
    fresh_path = f"{path}/{VERSION}={loaded}"
    if within is not None:
        with narrow_scans(spark):
            _write(latest, fresh_path, [within])
    else:
        place = F.spark_partition_id() if slots is None else F.pmod(_hash(keys), F.lit(slots))
        # The rows come evenly dealt by key: a task writes its share of each slot without another shuffle.
        sized = latest.hint("rebalance") if slots is None else latest
        with narrow_scans(spark):
            _write(sized.withColumn(PIECE, _piece(loaded, place)), fresh_path, [PIECE], gather=False)
        _locate(spark, path, loaded, latest.schema, keys)
    if guard is not None:
        guard()
    written = versions.written_parts(spark, path, loaded, 1)
    if not written:
        storage.remove(spark, fresh_path)
        return
    shape = latest.schema if within else T.StructType([*latest.schema.fields, T.StructField(PIECE, T.StringType())])
    fresh = spark.read.schema(shape).parquet(fresh_path)
    few = fresh.count() <= MAX_BROADCAST_ROWS  # footers only
    for attempt in range(ATTEMPTS):
        before = versions.state(spark, path) or State()
        touched = [w for w in written if w in before.parts] if within else _holding(fresh, path, before, keys, few)
        changes: dict[str, Part | None] = {name: Part(loaded) for name in written}
        if touched:
            again = versions.new_version()
            replaced = fresh.select(*keys)
            replaced = _sided(replaced, few)
            stored = versions.read_parts(spark, path, shape, before, touched)
            kept = stored.join(replaced, list(keys), "left_anti").select(*shape.names)
            if within:  # the kept rows and the new ones of a period are one version
                kept = kept.unionByName(fresh.filter(F.col(part).isin(_values(fresh, part, touched))))
            elif not few:  # they lie by key now, and make pieces as they lie
                kept = kept.withColumn(PIECE, _piece(again, F.spark_partition_id()))
            _write(kept, f"{path}/{VERSION}={again}", [part], gather=bool(within) and not few)
            if not within:
                _locate(spark, path, again, latest.schema, keys)
            left = versions.written_parts(spark, path, again, 1)
            changes |= dict.fromkeys(touched) | {name: Part(again) for name in left}
        try:
            # A key that another load brought meanwhile may lie in any piece; periods keep keys apart.
            versions.commit(spark, path, changes, before, written if within else None)
            return
        except TableChanged:
            if attempt == ATTEMPTS - 1:
                raise


def _values(rows: DataFrame, column: str, folders: Iterable[str]) -> list[object]:
    """Values of a partition column whose folders are named."""
    wanted = set(folders)
    return [r[0] for r in rows.select(column).distinct().collect() if _folder({column: r[0]}) in wanted]


def _piece(version: str, place: Column) -> Column:
    """Name of a piece that a version brought."""
    return F.concat_ws("-", F.lit(version[:12]), F.lpad(place.cast("string"), 6, "0"))


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys]).alias(HASH)


def _locate(
    spark: SparkSession, path: str, version: str, schema: T.StructType, keys: Sequence[str]
) -> None:
    """Store the key hashes of every piece of a version, reading its key columns back."""
    if not versions.written_parts(spark, path, version, 1):
        return
    named = T.StructType([*[schema[k] for k in keys], T.StructField(PIECE, T.StringType())])
    rows = spark.read.schema(named).parquet(f"{path}/{VERSION}={version}")
    hashes = rows.select(_hash(keys), PIECE)
    hashes.write.partitionBy(PIECE).parquet(f"{path}/_locator/{VERSION}={version}")


def _sided(keys: DataFrame, few: bool) -> DataFrame:
    """Keys of a load for a join: sent to every task through the driver only if their rows were counted as
    few. Spark goes by the size of the files, which sorted keys take little of."""
    return F.broadcast(keys) if few else keys.hint("merge")


def _holding(fresh: DataFrame, path: str, before: State, keys: Sequence[str], few: bool) -> list[str]:
    """The valid pieces that hold a key of ``fresh``, or one with its hash: at most all pieces."""
    if not before.folders():
        return []
    located = versions.read_parts(fresh.sparkSession, path, LOCATOR, before, below="_locator")
    held = located.join(_sided(fresh.select(_hash(keys)), few), HASH, "left_semi")
    return [_folder({PIECE: r[0]}) for r in held.select(PIECE).distinct().collect()]


def read_upserted(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    within: str | None = None,
    may_be_empty: bool = True,
) -> DataFrame:
    """The rows of an upserted table; ``within`` as for ``upsert``. A first load that stopped has
    written no table."""
    return read_table(spark, path, schema, may_be_empty)


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], below_rows: int) -> int:
    """Join the pieces with fewer than ``below_rows`` rows of an upserted table; returns how many there were.

    Rows are counted in the locator's footers. The new pieces are valid in one commit, and a load
    that came in between makes this one give way.
    """
    before = versions.state(spark, path) or State()
    located = versions.read_parts(spark, path, LOCATOR, before, below="_locator")
    sizes = located.groupBy(PIECE).count().filter(F.col("count") < below_rows).collect()
    small = [_folder({PIECE: r[0]}) for r in sizes]
    if len(small) < 2:
        return 0
    version = versions.new_version()
    rows = versions.read_parts(spark, path, schema, before, small)
    name = _piece(version, F.spark_partition_id())
    _write(rows.hint("rebalance").withColumn(PIECE, name), f"{path}/{VERSION}={version}", [PIECE], gather=False)
    _locate(spark, path, version, schema, keys)
    joined = {n: Part(version) for n in versions.written_parts(spark, path, version, 1)}
    versions.commit(spark, path, dict.fromkeys(small) | joined, before)
    return len(small)


def publish(rows: DataFrame, path: str) -> DataFrame:
    """Full refresh: write a new version, then point to it in one step. A run that stops
    before that leaves the table as it was; of two runs the later commit is valid, and both have
    written all their rows."""
    spark = rows.sparkSession
    version = versions.new_version()
    rows.write.mode("error").parquet(f"{path}/{VERSION}={version}")
    versions.commit(spark, path, {"": Part(version)})
    return spark.read.schema(rows.schema).parquet(f"{path}/{VERSION}={version}")
