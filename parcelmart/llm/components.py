"""Connected components of a link table, by contraction; every round is a Spark job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``links`` (columns ``a, b``); a component is named by one of its nodes.

    In a round every node points to the smallest of itself and its neighbours,
    the links are rewritten between the nodes pointed to, and those inside one
    node vanish. Names that are hashes, as here, fall in no order along a chain,
    so chains as well as stars shrink by a factor each round. Minima are combined
    map-side, so a node with very many links is one row per map task.
    """
    pairs = links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = stored(pairs.distinct(), "links")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    labels = stored(nodes.select("node", F.col("node").alias("component")), "labels")
    while not pairs.isEmpty():
        both = pairs.select(F.col("a").alias("n"), F.col("b").alias("m")).union(pairs.select("b", "a"))
        points = both.groupBy("n").agg(F.least(F.col("n"), F.min("m")).alias("to"))
        points = stored(points, "points")
        labels = labels.join(points, labels["component"] == points["n"], "left")
        labels = stored(labels.select("node", F.coalesce("to", "component").alias("component")), "labels")
        left = points.select(F.col("n").alias("a"), F.col("to").alias("a_to"))
        right = points.select(F.col("n").alias("b"), F.col("to").alias("b_to"))
        moved = pairs.join(left, "a").join(right, "b").where(F.col("a_to") != F.col("b_to"))
        moved = moved.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
        pairs = stored(moved.distinct(), "links")
    return labels
