"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); component is the smallest node that can be reached.

    Each round takes the smallest label among a node and its neighbours and then follows the label's own label,
    so long chains shorten by half; rounds are written to the shared folder. Neighbours' labels are merged before
    the shuffle, and adaptive execution splits the join where a node has very many. No edges give no nodes.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("low"))
        met = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("component").alias("was"), F.least("component", "low").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("beyond"))
        new = materialize(met.join(jump, "next", "left").select("node", "was", F.least("next", F.coalesce("beyond", "next")).alias("component")), "labels")
        labels = new.select("node", "component")
        if new.where("was <> component").isEmpty():
            return labels
