"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.operators.cutting import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the least node reachable) for every node of ``edges``; an edge from a node to itself names none.

    Each round takes the least label among a node and its neighbours and then follows labels of labels, so long chains
    shrink by halves. Labels and edges stay distributed; the driver sees one count a round.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = cut(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = cut(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("least")).select("node", F.least("node", "least").alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "y"), "y").select(F.col("x").alias("node"), "component")
        stepped = cut(near.unionByName(labels).groupBy("node").agg(F.min("component").alias("component")))
        jump = stepped.select(F.col("node").alias("component"), F.col("component").alias("further"))
        jumped = stepped.join(jump, "component").select("node", F.col("further").alias("component"))
        after = cut(jumped.join(labels.withColumnRenamed("component", "before"), "node"))
        labels = after.select("node", "component")
        if after.where("component <> before").isEmpty():
            return labels
