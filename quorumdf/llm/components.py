"""Connected components by contraction, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """doc_id -> component_id (smallest id of the component) for every node of an edge.

    Each round maps every node to the smallest id among itself and its
    neighbours, and contracts the edges by that map; a star collapses in one
    round.  The maps of the rounds are then followed one after another.  All
    tables stay distributed and are written between rounds.
    """
    left = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    loops = edges.select(F.col(a).alias("doc_id")).union(edges.select(F.col(b))).distinct()
    left = written(left, "edges")
    steps = []
    while not left.isEmpty():
        both = left.union(left.select("v", "u"))
        to = both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("node"), F.least("u", "low").alias("to"))
        # one jump through the map keeps chains of equal direction short
        up = to.select(F.col("node").alias("to"), F.col("to").alias("next"))
        to = written(to.join(up, "to", "left").select("node", F.coalesce("next", "to").alias("to")), "round")
        steps.append(to)
        u, v = to.select(F.col("node").alias("u"), F.col("to").alias("tu")), to.select(F.col("node").alias("v"), F.col("to").alias("tv"))
        left = left.join(u, "u").join(v, "v").select(F.least("tu", "tv").alias("u"), F.greatest("tu", "tv").alias("v"))
        left = written(left.filter("u <> v").distinct(), "edges")
    labels = loops.withColumn("component_id", F.col("doc_id"))
    for to in steps:
        labels = labels.join(to.withColumnRenamed("node", "component_id"), "component_id", "left").select(
            "doc_id", F.coalesce("to", "component_id").alias("component_id")
        )
    return written(labels, "components")
