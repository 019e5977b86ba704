"""Breadth-first search over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def crawl(links: DataFrame, seeds: DataFrame, max_depth: int = 3, max_pages: int | None = None) -> DataFrame:
    """(url, depth): pages reached from seeds (url) over links (src, dst), each at its least depth.

    Each level is an equi join of the frontier with links and an anti join with what is visited; the visited set is cut
    by a checkpoint each level. max_pages keeps the first by depth and url.
    """
    visited = seeds.select("url").distinct().withColumn("depth", F.lit(0)).checkpoint()
    for depth in range(1, max_depth + 1):
        frontier = visited.where(F.col("depth") == depth - 1)
        found = links.join(frontier, links["src"] == frontier["url"], "left_semi").select(F.col("dst").alias("url")).where(F.col("url").isNotNull()).distinct()
        new = found.join(visited, "url", "left_anti").withColumn("depth", F.lit(depth))
        grown = visited.unionByName(new).checkpoint()
        if grown.count() == visited.count():
            break
        visited = grown
    return visited.orderBy("depth", "url").limit(max_pages) if max_pages else visited
