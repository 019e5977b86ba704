"""Replies and what they answer, to any depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def thread_places(replies: DataFrame, id_col: str = "id", parent_col: str = "parent") -> DataFrame:
    """(id, root, depth, path): the first row of each row's thread, how far below it stands, and the ids from root to row.

    Every row knows its parent; each round a row takes over what the row that it points to points to, so a chain of n
    replies takes log2(n) rounds and not n. Rows that have reached their root leave the rounds. A row whose parent is
    null or isn't there is a root. Rows that lead into a circle have no root, depth or path. Ids are distinct; of rows
    that share one the one with the least parent counts. Paths are as long as threads are deep.
    """
    rows = replies.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(parent_col).alias("parent"))
    there = rows.select(F.col("id").alias("parent"), F.lit(True).alias("known"))
    at = rows.join(there, "parent", "left").select("id", F.when(F.col("known"), F.col("parent")).alias("up")).checkpoint()
    roots = at.where(F.col("up").isNull()).select("id", F.col("id").alias("root"), F.lit(0).alias("depth"), F.array("id").alias("path"))
    done = roots.checkpoint()
    open_ = at.where(F.col("up").isNotNull()).select("id", "up", F.lit(1).alias("depth"), F.array("id").alias("path")).checkpoint()
    left, rounds, most = open_.count(), 0, at.count()
    while left and 1 << rounds <= 2 * most:  # what is open then turns in a circle
        ends = done.select(F.col("id").alias("up"), F.col("root"), F.col("depth").alias("d"), F.col("path").alias("p"))
        steps = open_.select(F.col("id").alias("up"), F.col("up").alias("further"), F.col("depth").alias("d"), F.col("path").alias("p"))
        both = ends.withColumn("further", F.lit(None).cast(open_.schema["up"].dataType)).unionByName(steps.withColumn("root", F.lit(None).cast(open_.schema["id"].dataType)))
        moved = open_.join(both, "up").select("id", "root", F.col("further").alias("up"), (F.col("depth") + F.col("d")).alias("depth"), F.concat("p", "path").alias("path")).checkpoint()
        done = done.unionByName(moved.where(F.col("root").isNotNull()).select("id", "root", "depth", "path")).checkpoint()
        open_ = moved.where(F.col("root").isNull()).select("id", "up", "depth", "path")
        left, rounds = open_.count(), rounds + 1
    kind = at.schema["id"].dataType
    lost = open_.select("id", F.lit(None).cast(kind).alias("root"), F.lit(None).cast("int").alias("depth"), F.lit(None).cast(done.schema["path"].dataType).alias("path"))
    return done.unionByName(lost)


def reply_counts(replies: DataFrame, places: DataFrame, id_col: str = "id", parent_col: str = "parent") -> DataFrame:
    """(id, root, depth, replies, below): direct answers, and for a root all rows of its thread but itself; null for other rows."""
    direct = replies.groupBy(F.col(parent_col).alias("id")).agg(F.count("*").alias("replies"))
    below = places.where(F.col("depth") > 0).groupBy(F.col("root").alias("id")).agg(F.count("*").alias("below"))
    out = places.select("id", "root", "depth").join(direct, "id", "left").join(below, "id", "left")
    return out.select("id", "root", "depth", F.coalesce("replies", F.lit(0)).alias("replies"), F.when(F.col("depth") == 0, F.coalesce("below", F.lit(0))).alias("below"))
