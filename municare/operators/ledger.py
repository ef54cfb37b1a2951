"""Ledgers with different sign conventions brought to one signed shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEDGER_COLUMNS = (
    "fonte",
    "id_municipio",
    "data_referencia",
    "ano",
    "tipo_lancamento",
    "descricao_origem",
    "valor",
)


def ledger_entries(rows: DataFrame, source: str, **columns: Column) -> DataFrame:
    """Project a ledger to the common shape under its source tag."""
    wanted = {"fonte": F.lit(source), **columns}
    return rows.select(*[wanted[name].alias(name) for name in LEDGER_COLUMNS])


def union_ledgers(*ledgers: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, ledgers)
