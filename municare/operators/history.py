"""Latest row per key and presence over periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from municare.operators.skew import join_facts_back

ACTIVE = "ativo"
PAST = "historico"
GONE = "possivelmente_encerrado"


def latest_per_key(rows: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """One row per key, the newest first; NULL counts as newest, as in a descending sort of
    the source database. Ties are settled by the content of the row; where keys and order name every column
    there are none between different rows, and no hash of the row is shuffled.

    Spark keeps one row per key and map task before it shuffles, so a hot key sends one row
    per task to its reducer.
    """
    order = [F.desc_nulls_first(c) for c in newest_first]
    if not order or not {*keys, *newest_first}.issuperset(rows.columns):
        order.append(F.xxhash64(*rows.columns).desc())
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = rows.withColumn("__rank", F.row_number().over(window))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def presence_status(
    rows: DataFrame,
    key: str,
    period: str,
    first: str = "primeira_competencia_observada",
    last: str = "ultima_competencia_observada",
    status: str = "situacao_operacional",
) -> DataFrame:
    """First and last period of each key, and what the last one says about it.

    A row before its key's last period is history; at the last period the key is active
    when that is also the newest period loaded, otherwise it may have closed.
    """
    spans = rows.groupBy(key).agg(
        F.min(period).alias(first), F.max(period).alias(last), F.count("*").alias("__rows")
    )
    newest = spans.agg(F.max(last)).scalar()
    placed = join_facts_back(rows, spans, [key], "__rows", total=F.sum("__rows"))
    return placed.withColumn(
        status,
        F.when(F.col(period) < F.col(last), F.lit(PAST))
        .when(F.col(last) == newest, F.lit(ACTIVE))
        .otherwise(F.lit(GONE)),
    )
