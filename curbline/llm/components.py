"""Connected components of an undirected graph of 64-bit nodes, with checkpoints in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import remove_folder
from .runtime import stored, stored_at


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (a, b).

    Every node takes the least label among its own and its neighbours', then the label of that label, until no
    label changes: rounds grow with the logarithm of a component's diameter in practice. No step gathers the
    neighbours of a node; each is a minimum and a join, and its result is written to the shared folder.
    """
    half = edges.where("a <> b").select("a", "b")
    both = stored(half.unionByName(half.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels, folder = stored_at(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    for _ in range(rounds):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        least = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("least"))
        jump = labels.select(F.col("node").alias("least"), F.col("label").alias("beyond"))
        after = least.join(jump, "least").select("node", F.least("least", "beyond").alias("label"), (F.least("least", "beyond") < F.col("label")).alias("moved"))
        after, last = stored_at(after, "labels")
        remove_folder(edges.sparkSession, folder)  # the round before; nothing reads it any more
        labels, folder = after.select("node", "label"), last
        if after.where("moved").isEmpty():
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
