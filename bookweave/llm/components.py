"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookweave.llm.common import discard, stored


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """node, component (the smallest node reachable) of every node of edges (a, b).

    Labels only ever pass through joins and minima that combine before the shuffle, so a node with very
    many neighbours is no single task's work; each round is written to the shared folder. Jumping to the
    label's own label makes the rounds few; raises if labels still move after `rounds` of them.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    for _ in range(rounds):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        moved = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        to = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = stored(moved.join(to, "label").select("node", "old", F.least("label", "next").alias("label")), "labels")
        discard(labels)
        labels = new.drop("old")
        if new.filter("label <> old").isEmpty():
            discard(both)
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"labels still move after {rounds} rounds")
