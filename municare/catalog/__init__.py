"""Queries over the star-schema test tables, each next to the SQL that checks it."""

from municare.catalog import intake, loads, models, relational, suite, writes  # noqa: F401  (register their queries)
from municare.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
