"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radiolith.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; root is the component's smallest node.

    Each round joins every node to the smallest neighbour it sees: the larger neighbours first, then the
    smaller ones and itself (Kiveris and others, 2014). Nodes meet their minimum by an aggregate with
    partial sums and a join, never as a collected list, so a hot node is split like any skewed key. Rounds
    grow with the logarithm of the graph. Each is cut by a checkpoint. The root itself is not a row.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    state = None
    while True:
        both = edges.select("v", "u").union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(low, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        tied = large.join(low, "v")
        small = tied.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        edges = cut(small.union(low.select("v", F.col("m").alias("u"))).where("v <> u").distinct())
        total = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if tuple(total) == state:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
        state = tuple(total)
