"""Landed files to validated raw tables."""

from municare.sources.landing import (
    annual_prefix,
    find_parts,
    monthly_prefix,
    read_parts,
    read_records,
)
from municare.sources.lookups import REFERENCE_MUNICIPALITIES, read_seed, reference_municipalities
from municare.sources.raw import SOURCES, normalize, provenance
from municare.sources.validate import (
    EmptySource,
    MissingField,
    PageLimitReached,
    field_audit,
    must,
    refuse,
    require_columns,
    require_fields,
    require_rows,
    reject_full_pages,
)

__all__ = [
    "EmptySource",
    "MissingField",
    "PageLimitReached",
    "REFERENCE_MUNICIPALITIES",
    "SOURCES",
    "annual_prefix",
    "field_audit",
    "find_parts",
    "monthly_prefix",
    "must",
    "normalize",
    "provenance",
    "read_parts",
    "read_records",
    "read_seed",
    "reference_municipalities",
    "reject_full_pages",
    "refuse",
    "require_columns",
    "require_fields",
    "require_rows",
]
