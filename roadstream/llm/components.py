"""Connected components by repeated contraction, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b): all nodes of a component share a root.

    Every round points each node at the smallest of itself and its neighbours and replaces both
    ends of each edge by what they point at, until no edge joins two different nodes. Node names
    should be hashes: in random order a constant share of the nodes goes each round, however the
    edges run. Loops, repeated and reversed edges are harmless; nulls are ignored.
    """
    known = edges.where("a IS NOT NULL AND b IS NOT NULL")
    both = known.select("a", "b").union(known.select(F.col("b"), F.col("a")))
    left = checkpointed(both.distinct())
    labels = left.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
    while not (rest := left.where("a <> b")).isEmpty():
        least = rest.groupBy("a").agg(F.min("b").alias("low"))
        step = checkpointed(least.select("a", F.least("a", "low").alias("to")))
        labels = checkpointed(
            labels.join(step.withColumnRenamed("a", "root"), "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")
            )
        )
        left = checkpointed(
            rest.join(step, "a")
            .select(F.col("to").alias("a"), "b")
            .join(step.select(F.col("a").alias("b"), F.col("to").alias("other")), "b")
            .select("a", F.col("other").alias("b"))
            .where("a <> b")
            .distinct()
        )
    return labels
