"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.common import written


def connected(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root``: each linked node with the smallest node that it can reach.

    ``links`` has columns ``a`` and ``b``. Alternates star steps: every node's larger
    neighbours, then its smaller ones, are tied to its smallest neighbour, until nothing changes. Each step sums by
    node before it joins, and is written, so that lineage stays short. A hub's links
    are split by the join's skew handling and never gathered.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")
    marks = None
    for _ in range(most_rounds):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        )
        smallest = larger.groupBy("u").agg(F.min("v").alias("m"))
        tied = larger.join(smallest, "u")
        edges = written(
            tied.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(tied.select("u", F.col("m").alias("v")))
            .where("u > v")
            .distinct(),
            "edges",
        )
        # Done when every node has one link and it leads to a node without a smaller one.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == marks:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        marks = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
