"""Connected components over a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstream.llm.common import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, root for every node that a link names; root is the component's smallest node.

    Each round links every larger neighbour, then every smaller one, to the smallest neighbour; the number of rounds grows
    with the logarithm of the component's length. A round's links are written to the shared folder, so
    lineage stays short and a lost executor's part is read again. Smallest neighbours are found with partial aggregation;
    a node with very many links is a skewed join key, which adaptive execution splits.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    edges = stored(edges)
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u")
        edges = stored(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
            .where("u != v").distinct()
        )
        state = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.count_distinct("u")).first()
        if state == before and state[0] == state[2]:
            break
        before = state
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
