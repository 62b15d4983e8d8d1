"""Connected components of a list of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); nodes of one component share their root.

    Each round, nodes join the least of their neighbours and links between joined nodes vanish. Nodes should be hashes:
    then a fixed share of the nodes goes in each round, whatever the links look like.
    """
    edges = staged(links.select("a", "b").where("a != b").distinct(), "links")
    roots: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = staged(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("up")), "links")
        # Two steps up at once: a parent may itself have joined another node.
        above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
        parent = staged(parent.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("root")), "links")
        if roots is None:
            roots = parent
        else:
            step = parent.select(F.col("node").alias("root"), F.col("root").alias("new"))
            roots = staged(roots.join(step, "root", "left").select("node", F.coalesce("new", "root").alias("root")), "links")
        up = lambda side: parent.select(F.col("node").alias(side), F.col("root").alias(f"{side}_up"))
        edges = staged(edges.join(up("a"), "a").join(up("b"), "b").select(F.col("a_up").alias("a"), F.col("b_up").alias("b"))
                       .where("a != b").distinct(), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if roots is None else roots
