"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameweir.session import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of the links (a, b) the smallest node that links
    lead to. Nodes are numbers.

    Two steps alternate: each node hands its smaller neighbours to the smallest
    of them, then its larger ones. Every step keeps what is connected, links
    only grow shorter, and the last state is a star around each root. Each
    state is a table in the shared folder, so lost executors cost no earlier
    step. A hub is aggregated by partial minima; its links are never gathered.
    """
    both = F.col("a") != F.col("b")
    state = links.where(both).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state, before = stored(state, "links"), None
    while True:
        # large star: larger neighbours of a node go to its smallest neighbour
        near = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: smaller neighbours, and the node itself, go to the smallest
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        low = large.join(least, "a")
        small = low.select(F.col("b").alias("a"), F.col("m").alias("b")).where(both)
        state = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        digest = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if digest == before:
            break
        before = digest
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
