"""Relational operators that take column names, so they run on any table."""

from municare.operators.alerts import federate_rules, label_pair, rule
from municare.operators.distinct import distinct_counts, distinct_state
from municare.operators.history import latest_per_key, presence_status
from municare.operators.ledger import ledger_entries, union_ledgers
from municare.operators.lookup import (
    aggregate_then_label,
    bounded,
    keep_scope,
    left_lookup,
    membership_flag,
    role_lookup,
)
from municare.operators.merge import keep_other_partitions, upsert_rows
from municare.operators.order import running_max_before, running_sum
from municare.operators.ranges import overlapping, range_lookup, resolve_codes, sweep_lookup
from municare.operators.skew import join_facts_back, spread_lookup

__all__ = [
    "aggregate_then_label",
    "bounded",
    "distinct_counts",
    "distinct_state",
    "federate_rules",
    "join_facts_back",
    "keep_other_partitions",
    "keep_scope",
    "label_pair",
    "latest_per_key",
    "ledger_entries",
    "left_lookup",
    "membership_flag",
    "overlapping",
    "presence_status",
    "range_lookup",
    "resolve_codes",
    "role_lookup",
    "rule",
    "running_max_before",
    "running_sum",
    "spread_lookup",
    "sweep_lookup",
    "union_ledgers",
    "upsert_rows",
]
