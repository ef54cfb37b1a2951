"""Connected components of links held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municare.llm.common import is_empty, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a long, b long); component = smallest node.

    Each round gives a node the smallest label around it and then the label of its label, so
    the rounds grow with the logarithm of a chain. Links and labels are plain tables in every
    join, which lets AQE split the partition of a hub; minima are taken map-side first. Links
    with a null end or from a node to itself connect nothing; no links give no rows.
    """
    links = links.filter("a is not null and b is not null and a != b")
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both, "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("label"))
    labels = stored(labels, "labels")
    while True:
        around = both.join(labels, F.col("b") == F.col("node"))
        around = around.select(F.col("a").alias("node"), "label", F.lit(None).cast("long").alias("own"))
        seen = labels.select("node", "label", F.col("label").alias("own")).union(around)
        best = seen.groupBy("node").agg(F.min("label").alias("label"), F.max("own").alias("own"))
        best = stored(best, "labels")
        if is_empty(best.filter("label != own")):
            return best.select("node", F.col("label").alias("component"))
        up = best.select(F.col("node").alias("up"), F.col("label").alias("up_label"))
        jumped = best.join(up, F.col("label") == F.col("up"))
        labels = stored(jumped.select("node", F.col("up_label").alias("label")), "labels")
