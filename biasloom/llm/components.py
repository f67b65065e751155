"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biasloom.llm.common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: neighbours are linked to the least node around.

    The least neighbour is a map-side reduced aggregate and comes back by a
    join that AQE may split, so a node of any degree makes no hot task.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = edges.select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("node"), F.least("m", "u").alias("m"))
    joined = both.join(least, F.col("u") == F.col("node"))
    if large:
        linked = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))
        )
    return linked.filter("u != v").distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (node, root) for every node of links (u, v); root is the least node.

    Links are long pairs in any order, repeats and loops allowed. Each round is
    written to the shared folder; the number of rounds grows with the logarithm
    of the longest chain.
    """
    edges = scratch.keep(
        links.filter("u != v").select("u", "v").distinct(), "links-0"
    )
    turn, before = 0, None
    while True:
        turn += 1
        edges = scratch.keep(_star(_star(edges, True), False), f"links-{turn}")
        mark = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        scratch.drop(f"links-{turn - 1}")
        if tuple(mark) == before:
            break
        before = tuple(mark)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct()
    )
