"""Build the marts and check them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from municare.operators import quality
from municare.plans.checks import CHECKS
from municare.plans.registry import MODELS, Workspace, build_order
from municare.sinks import publish, read_table, refresh_incremental, table_path

PRODUCTION = "fct_producao_ambulatorial"
RAW_PRODUCTION = "raw_sia.producao_ambulatorial"
ARRIVAL = "competencia_arquivo"


def build_marts(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    bootstrap_period: str | None = None,
    names: Sequence[str] | None = None,
) -> Workspace:
    """Views stay views (lazy, and temporary views by name); marts become tables under
    ``<root>/marts``, and the production fact only refreshes the arrival periods that changed
    or the one given by ``bootstrap_period``, told by the ledgers of both tables and without a shuffle, as the raw table is stored by
    arrival period too. Later models read the stored marts."""
    space = Workspace(spark, raw)
    for name in build_order(names):
        found = MODELS[name]
        if found.layer != "marts":
            space[name].createOrReplaceTempView(name)
            continue
        path = table_path(root, found.layer, name)
        if name == PRODUCTION:
            staged, bridge = (space[r] for r in found.reads)
            ledger = raw.ledger(RAW_PRODUCTION, ARRIVAL) if hasattr(raw, "ledger") else None
            refresh_incremental(
                staged,
                path,
                lambda rows: found.build(rows, bridge),
                ARRIVAL,
                only=bootstrap_period,
                aligned=True,
                offered=ledger,
            )
            space.put(name, read_table(spark, path, found.build(staged, bridge).schema))
        else:
            space.put(name, publish(space[name], path))
    return space


def open_marts(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    names: Sequence[str] | None = None,
) -> Workspace:
    """A workspace over the stored marts, all or ``names``; views are defined again on the raw
    tables. A mart that was never built is an error."""
    space = Workspace(spark, raw)
    for name in build_order() if names is None else names:
        if MODELS[name].layer == "marts":
            found = MODELS[name]
            schema = found.build(*[space[r] for r in found.reads]).schema
            path = table_path(root, found.layer, name)
            space.put(name, read_table(spark, path, schema, may_be_empty=False))
    return space


def check_marts(space: Workspace, root: str) -> DataFrame:
    """Run the declared checks, store their results, and stop on a failed check that is not
    a mere warning."""
    results = publish(run_checks(space), table_path(root, "quality", "dq_results"))
    quality.enforce(results)
    return results


def run_checks(space: Workspace, checks: Sequence[quality.Check] = CHECKS) -> DataFrame:
    """Results of the declared checks over the tables of a workspace."""
    wanted = {c.model for c in checks} | {c.parent for c in checks if c.parent}
    return quality.run(checks, {name: space[name] for name in sorted(wanted)})
