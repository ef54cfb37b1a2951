"""Incremental ingest of a landing folder."""

from municare.streaming.landing import ingest_landing, ingest_landing_parts

__all__ = ["ingest_landing", "ingest_landing_parts"]
