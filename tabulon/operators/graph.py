"""Bounded breadth-first traversal of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reachable(edges: DataFrame, roots: DataFrame, max_depth: int) -> DataFrame:
    """(node, depth): nodes within ``max_depth`` links of the roots, each at its least depth.

    A round joins the frontier only and anti-joins what is known, so a page is
    expanded once; the depth bounds the plan's length.
    """
    links = edges.select("src", "dst").distinct()
    seen = roots.select("node").distinct().withColumn("depth", F.lit(0))
    frontier = seen
    for depth in range(1, max_depth + 1):
        found = frontier.join(links, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        frontier = found.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth))
        seen = seen.unionByName(frontier)
    return seen
