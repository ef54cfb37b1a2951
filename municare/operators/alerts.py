"""Rule results in one shape, keyed and named."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municare.functions import surrogate_key
from municare.operators.lookup import left_lookup

RULE_COLUMNS = (
    "codigo_regra",
    "descricao_regra",
    "severidade",
    "tipo_entidade",
    "id_municipio",
    "periodo_referencia",
    "evidencia",
)


def label_pair(
    rows: DataFrame,
    keys: Sequence[str],
    label_column: str,
    value: str,
    first: tuple[str, str],
    second: tuple[str, str],
) -> DataFrame:
    """Put two labelled values of a long table side by side: ``(label, output name)`` each.

    Copies of a line pair with each other, as in the source database; the uniqueness check on
    the alert id is what reports them.
    """

    def side(label: str, name: str) -> DataFrame:
        chosen = rows.filter(F.col(label_column) == label)
        return chosen.select(*keys, F.col(value).alias(name))

    return side(*first).join(side(*second), list(keys), "inner")


def rule(
    rows: DataFrame,
    code: str,
    description: str,
    severity: str,
    period: Column,
    evidence: Column,
    entity: str = "municipio",
) -> DataFrame:
    """One alert per row; rule metadata become constant columns."""
    return rows.select(
        F.lit(code).alias("codigo_regra"),
        F.lit(description).alias("descricao_regra"),
        F.lit(severity).alias("severidade"),
        F.lit(entity).alias("tipo_entidade"),
        F.col("id_municipio"),
        period.alias("periodo_referencia"),
        evidence.alias("evidencia"),
    ).select(*RULE_COLUMNS)


def federate_rules(
    rules: Sequence[DataFrame], municipalities: DataFrame, status: str = "ativo"
) -> DataFrame:
    """Union of the rules with a stable id and the municipality's name. An alert without a
    municipality has no id."""
    alerts = reduce(DataFrame.unionByName, rules)
    named = left_lookup(
        alerts,
        municipalities,
        {"id_municipio": "id_municipio"},
        {"nome_municipio": "nome_municipio"},
    )
    return named.select(
        surrogate_key("codigo_regra", "id_municipio", "periodo_referencia").alias("id_alerta"),
        "codigo_regra",
        "descricao_regra",
        "severidade",
        "tipo_entidade",
        "id_municipio",
        "nome_municipio",
        "periodo_referencia",
        "evidencia",
        F.lit(status).alias("status"),
    )
