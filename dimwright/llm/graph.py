"""Connected components of a link table: union-find as label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import save_table


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (smallest reachable node) for every end of ``links`` (two long columns).

    Each round takes the smallest label among a node and its neighbours, then jumps to that label's own
    label; the rounds needed grow with the logarithm of the longest path.  Minima are aggregated
    before the shuffle, so a node with very many links is no hot spot, and every round's labels are
    written to the shared folder.  Links with a null end, and from a node to itself, are ignored.
    """
    there = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v")
    both = save_table(there.unionByName(there.select(F.col("v").alias("u"), F.col("u").alias("v"))), "links")
    labels = both.groupBy("u").agg(F.min("v").alias("least"))
    labels = save_table(labels.select(F.col("u").alias("node"), F.least("u", "least").alias("component")), "labels")
    before = None
    while True:
        # the labels only ever fall, so an unchanged sum means no label changed
        total = labels.agg(F.sum(F.col("component").cast("decimal(38,0)")).alias("s")).first()["s"]
        if total == before:
            return labels
        before = total
        near = (both.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("component").alias("least")))
        step = labels.join(near.withColumnRenamed("u", "node"), "node").select(
            "node", F.least("component", "least").alias("component"))
        step = save_table(step, "labels")
        jump = step.select(F.col("node").alias("component"), F.col("component").alias("further"))
        labels = save_table(step.join(jump, "component").select("node", F.col("further").alias("component")), "labels")
