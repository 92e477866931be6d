"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgauge.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable, for every node of the links (a, b) but the roots themselves.

    In turn, the larger and the smaller neighbours of each node are hung to its smallest neighbour, until
    every tree is a star. A node's neighbours are only ever reduced to their minimum, never gathered, so a
    node with very many links is no burden. Each turn is written to the shared folder.
    """
    up = F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")
    edges = stored(links.where("a <> b").select(*up).distinct(), "links")
    state = None
    while True:
        # large stars: larger neighbours go to the smallest of node and neighbours
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("m")).select("node", F.least("node", "m").alias("m"))
        large = both.where("root > node").join(least, "node").select(F.col("root").alias("node"), F.col("m").alias("root"))
        large = large.where("node <> root").distinct()
        # small stars: smaller neighbours and the node itself go to the smallest of them
        least = large.groupBy("node").agg(F.min("root").alias("m"))
        small = large.join(least, "node").where("root <> m").select(F.col("root").alias("node"), F.col("m").alias("root"))
        edges = stored(small.unionByName(least.withColumnRenamed("m", "root")).distinct(), "links")
        row = edges.agg(F.count(F.lit(1)), F.countDistinct("node"), F.sum(F.xxhash64("node", "root").cast("decimal(20,0)"))).first()
        if tuple(row) == state:
            return edges
        state = tuple(row)
