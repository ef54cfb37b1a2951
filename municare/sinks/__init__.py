"""Idempotent writes: upsert, partition replacement, incremental refresh, full refresh."""

from municare.sinks.incremental import refresh_incremental, stale_partitions
from municare.sinks.tables import (
    MissingTable,
    TableChanged,
    compact,
    loads,
    publish,
    read_table,
    read_upserted,
    replace_partitions,
    sweep,
    table_path,
    upsert,
)

__all__ = [
    "MissingTable",
    "TableChanged",
    "compact",
    "loads",
    "publish",
    "read_table",
    "read_upserted",
    "refresh_incremental",
    "replace_partitions",
    "stale_partitions",
    "sweep",
    "table_path",
    "upsert",
]
