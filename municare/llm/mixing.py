"""Mixing sources to target weights by weighted fair queueing.

Method: every source gets a target, its share of the budget. A document arrives up to twice,
the second time after all documents of its source arrived once. In the shuffled order of its
source it gets a virtual finish time: the source's words up to and with it, divided by the
source's target. One global range sort by finish time merges the queues, and the mix ends
where the words reach the budget, the sum of the targets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from municare.llm.common import count_words, map_texts, stored, with_running_sum

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # budget over all words
REPEATS = 2  # times a source, and a document, is used at most


def targets(sources: DataFrame, weights: Sequence[float], share: float, repeats: int) -> DataFrame:
    """``sources`` (source, source_size), one row each, with their ``target``.

    Weights repeat along the sources by code point, null last. No target exceeds ``repeats``
    times its source; what is above goes to the others by weight. With a common level t,
    target = min(cap, weight * t), so the sources that end at their cap are the first ones by
    cap / weight: one sorted pass finds the level instead of rounds of resharing. A row per
    source passes one task, as the order of all sources asks for.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place.cast("int"))
    cap = F.col("source_size") * F.lit(float(repeats))
    rows = sources.withColumn("__weight", weight).withColumn("__cap", cap)
    everything = Window.partitionBy()
    rows = rows.withColumn("__budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    # Places first in the queue of caps: their caps summed, and the weights of the rest.
    queue = Window.orderBy(F.col("__cap") / F.col("__weight"), F.col("source").asc_nulls_last())
    ahead = queue.rowsBetween(Window.unboundedPreceding, -1)
    rest = queue.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("__budget") - F.coalesce(F.sum("__cap").over(ahead), F.lit(0.0))) / F.sum("__weight").over(rest)
    rows = rows.withColumn("__level", level)
    rows = rows.withColumn("__place", F.row_number().over(queue))
    # The level is right at the first source that stays within its cap; when none does, all
    # sources end at their caps.
    fits = F.col("__level") * F.col("__weight") <= F.col("__cap")
    rows = rows.withColumn("__first", F.min(F.when(fits, F.col("__place"))).over(everything))
    rows = rows.withColumn("__t", F.max(F.when(F.col("__place") == F.col("__first"), F.col("__level"))).over(everything))
    target = F.when(F.col("__t").isNull(), F.col("__cap")).otherwise(F.least("__cap", F.col("__t") * F.col("__weight")))
    return rows.select("source", "source_size", target.alias("target"))


def mix(
    documents: DataFrame,
    size: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: int = 8,
) -> DataFrame:
    """Per row of ``documents`` (doc_id, text, source): doc_id, source, size, source_size, target
    and times, how often the mix takes it.

    ``size`` is a column of ``documents`` to count by, by default the words of the text (null:
    0). A null source is a source of its own. The order of a source is a hash of id, size and
    ``seed``, so reruns agree; rows that agree in all of these may change places. Documents
    without words cost nothing and are taken where their finish time lies. Other columns are
    not read.
    """
    if size is None:
        rows = map_texts(documents, ["doc_id", "source"], "text", lambda t: {"size": count_words(t)}, "size bigint")
    else:
        rows = documents.select("doc_id", "source", size.cast("long").alias("size"))
    rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(sources, weights, share, repeats), "targets")

    order = F.xxhash64(F.lit(seed), "doc_id", "size")
    arrivals = rows.select("*", F.explode(F.array(*[F.lit(i) for i in range(repeats)])).alias("__pass"))
    arrivals = arrivals.withColumn("__shuffled", order)
    queued = with_running_sum(
        arrivals, ["source"], [F.col("__pass"), F.col("__shuffled"), F.col("__row")], "size", "__served", "queues"
    )
    goal = goals.select(F.col("source").alias("__source"), "source_size", "target")
    # One row per source; a session too small for a broadcast splits hot sources by AQE.
    timed = stored(queued, "queued").join(goal, F.col("source").eqNullSafe(F.col("__source")))
    finish = F.when(F.col("target") > 0, F.col("__served") / F.col("target")).otherwise(F.lit(0.0))
    timed = timed.withColumn("__finish", finish).drop("__source")
    merged = with_running_sum(
        timed, [], [F.col("__finish"), F.col("__pass"), F.col("__shuffled"), F.col("__row")], "size", "__total", "merged"
    )
    budget = goals.agg(F.sum("target")).scalar()
    taken = F.sum(F.when(F.col("__total") <= budget, F.lit(1)).otherwise(F.lit(0)))
    counted = merged.groupBy("__row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("source").alias("source"),
        F.first("size").alias("size"),
        F.first("source_size").alias("source_size"),
        F.first("target").alias("target"),
        taken.cast("int").alias("times"),
    )
    return counted.drop("__row")


def mixture(documents: DataFrame, **how) -> DataFrame:
    """The rows of ``documents``, each as often as the mix takes it, with their columns.

    Rows that share an id share its times: an id stands for one document of the mix.
    """
    times = mix(documents, **how).groupBy("doc_id").agg(F.max("times").alias("__times"))
    times = stored(times.filter("__times > 0").withColumnRenamed("doc_id", "__doc"), "times")
    # One plan at every size: texts and times meet by a sorted merge.
    joined = documents.join(times.hint("merge"), documents["doc_id"].eqNullSafe(times["__doc"]))
    again = F.explode(F.sequence(F.lit(1), F.col("__times")))
    return joined.select(*[documents[c] for c in documents.columns], again.alias("__again")).drop("__again")
