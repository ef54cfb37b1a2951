"""Which files of a table are valid: a pointer file, replaced in one step under a lock.

``<table>/_current`` names for every part of a table (a partition, or a piece of an upserted table) the
version that holds its rows, ``<table>/_version=<id>/<part>``. A load writes a version of its own and then
commits: parts that it filled, emptied and left alone become valid together, or none does. Loads that run at
the same time write to different folders; each commit starts from the pointer of that moment, so writers of
different parts keep each other's work, and one that read a part which has changed since is refused.

The pointer also is the ledger of loads: rows and newest load time of each part.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from municare import storage

POINTER = "_current"
LOCK = "_lock"
VERSION = "_version"
KEEP_SECONDS = 24 * 3600  # how long replaced versions stay for readers that began before


class MissingTable(ValueError):
    """A table that was never written."""


class TableChanged(RuntimeError):
    """Another load changed what this one had read."""


@dataclass(frozen=True)
class Part:
    """A valid part: its version (None: known to hold no rows), its rows and newest load, if told."""

    version: str | None
    rows: int | None = None
    newest: int | None = None  # microseconds since 1970


@dataclass(frozen=True)
class State:
    """What a pointer says; ``serial`` counts the commits."""

    serial: int = 0
    parts: Mapping[str, Part] = field(default_factory=dict)
    retired: tuple[tuple[str, float], ...] = ()

    def folders(self, wanted: Iterable[str] | None = None) -> list[str]:
        """Folders below the table, of all parts or the wanted ones that hold rows."""
        names = self.parts if wanted is None else wanted
        held = ((name, self.parts[name].version) for name in names if name in self.parts)
        return [_folder(name, version) for name, version in held if version]


def _folder(part: str, version: str) -> str:
    return f"{VERSION}={version}/{part}" if part else f"{VERSION}={version}"


def new_version() -> str:
    return uuid.uuid4().hex


def state(spark: SparkSession, path: str) -> State | None:
    """The pointer of a table, None where there is none."""
    text = storage.read_text(spark, f"{path}/{POINTER}")
    if not text:
        return None
    told = json.loads(text)
    parts = {name: Part(**part) for name, part in told["parts"].items()}
    return State(told["serial"], parts, tuple(map(tuple, told["retired"])))


def commit(
    spark: SparkSession,
    path: str,
    changes: Mapping[str, Part | None],
    read: State | None = None,
    relies_on: Iterable[str] | None = None,
) -> State:
    """Make ``changes`` valid, all at once: a part for each name, None for a part that is gone.

    ``read`` is the state that the load read: the parts in ``relies_on``, or the whole table where that is
    None, must still be as they were. Without ``read`` the load used nothing that was stored.
    """
    with storage.locked(spark, f"{path}/{LOCK}"):
        now = state(spark, path) or State()
        if read is not None and relies_on is None and now.serial != read.serial:
            raise TableChanged(f"{path} was changed by another load")
        for name in relies_on or ():
            if now.parts.get(name) != read.parts.get(name):
                raise TableChanged(f"{path}: {name or 'the table'} was changed by another load")
        parts, gone = dict(now.parts), []
        for name, part in changes.items():
            old = parts.pop(name, None)
            if old is not None and old.version and (part is None or part.version != old.version):
                gone.append((_folder(name, old.version), time.time()))
            if part is not None:
                parts[name] = part
        kept, expired = _expired(now.retired, time.time())
        after = State(now.serial + 1, parts, (*kept, *gone))
        storage.replace_text(spark, f"{path}/{POINTER}", _json(after))
    for folder in expired:
        storage.remove(spark, f"{path}/{folder}")
        storage.remove(spark, f"{path}/_locator/{folder}")
    return after


def _expired(
    retired: Sequence[tuple[str, float]], now: float
) -> tuple[list[tuple[str, float]], list[str]]:
    kept = [(folder, at) for folder, at in retired if now - at < KEEP_SECONDS]
    return kept, [folder for folder, at in retired if now - at >= KEEP_SECONDS]


def _json(state: State) -> str:
    parts = {name: {"version": p.version, "rows": p.rows, "newest": p.newest} for name, p in state.parts.items()}
    return json.dumps({"serial": state.serial, "parts": parts, "retired": state.retired})


def read_parts(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    found: State,
    wanted: Iterable[str] | None = None,
    below: str = "",
) -> DataFrame:
    """Rows of the valid parts, all or the wanted ones, under ``schema``."""
    root = f"{path}/{below}" if below else path
    folders = [f"{root}/{f}" for f in found.folders(wanted)]
    if not folders:
        return spark.createDataFrame([], schema)
    versioned = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    rows = spark.read.schema(versioned).option("basePath", root).parquet(*folders)
    return rows.select(*[F.col(f"`{name}`") for name in schema.names])


def written_parts(spark: SparkSession, path: str, version: str, depth: int) -> list[str]:
    """Parts that a version holds files of; ``depth`` partition columns make a part."""
    found = [""]
    for _ in range(depth):
        found = [
            f"{above}/{name}".lstrip("/")
            for above in found
            for name in storage.names(spark, f"{path}/{VERSION}={version}/{above}")
            if "=" in name
        ]
    return found


def sweep(spark: SparkSession, path: str, older_than: float = KEEP_SECONDS) -> list[str]:
    """Remove versions that no pointer names and that nothing was written to for ``older_than`` seconds:
    what failed loads left. A load that still runs writes to its folder and so keeps it."""
    found = state(spark, path) or State()
    named = {f.split("/")[0] for f in found.folders()} | {f.split("/")[0] for f, _ in found.retired}
    gone = []
    for name in storage.names(spark, path):
        if name.startswith(f"{VERSION}=") and name not in named:
            if time.time() - storage.last_change(spark, f"{path}/{name}") > older_than:
                storage.remove(spark, f"{path}/{name}")
                gone.append(name)
    return gone
