"""Connected components over an edge table, in joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node of its component.

    Every round each node takes the smallest label among its own, its label's and its neighbours', so
    chains shrink by jumps; each round is written, which cuts the lineage. Nothing reaches the driver but
    the number of changed labels.
    """
    both = saved(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
    labels = saved(labels.select("node", F.least("node", "b").alias("root")), "labels")
    while True:
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = labels.join(up, "root", "left").select("node", "root", F.coalesce("above", "root").alias("near"))
        offers = both.join(labels.select(F.col("node").alias("b"), "root"), "b").select(F.col("a").alias("node"), "root")
        best = offers.groupBy("node").agg(F.min("root").alias("offer"))
        step = jumped.join(best, "node").select("node", F.least("near", "offer").alias("root"), F.col("root").alias("old"))
        step = saved(step, "labels")
        labels = step.select("node", "root")
        if step.where("root != old").isEmpty():
            return labels
