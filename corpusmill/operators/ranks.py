"""Medians and greatest counts without one task that holds a group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_medians(df: DataFrame, group: list[str], value: str, parts: int = 64) -> DataFrame:
    """(group, median): the exact median of a number by group, null where a group has none; null and non-finite values don't count.

    Values are counted by group first, which combines before it shuffles. For each of the two middle ranks of a group, a
    pass cuts the values that still may have it at `parts` approximate quantiles, counts the parts exactly, and keeps the
    part that holds the rank. So passes grow with the logarithm of a group's distinct values, whatever their spread, and
    a task has counts of parts and sketches, never a group's values.
    """
    v = F.col(value).cast("double") if df.schema[value].dataType.typeName() in ("float", "double") else F.col(value).cast("long")
    counted = df.select(F.struct(*group).alias("g"), v.alias("v")).groupBy("g", "v").agg(F.count("*").alias("n")).checkpoint()
    finite = counted.where(F.abs(F.col("v").cast("double")) < float("inf"))
    ranks = finite.groupBy("g").agg(F.sum("n").alias("all")).select("g", F.posexplode(F.array(F.expr("(all - 1) div 2"), F.expr("all div 2"))).alias("t", "k"))
    inside, done = finite.join(ranks, "g").checkpoint(), []
    while not inside.isEmpty():
        cuts = F.percentile_approx("v", [i / parts for i in range(1, parts)], 20 * parts).alias("cuts")
        ends = inside.groupBy("g", "t").agg(F.first("k").alias("k"), F.min("v").alias("lo"), F.max("v").alias("hi"), cuts).checkpoint()
        done.append(ends.where(F.col("lo") == F.col("hi")).select("g", F.col("lo").alias("v")))
        parted = inside.drop("k").join(ends.where(F.col("lo") < F.col("hi")).select("g", "t", "k", "cuts"), ["g", "t"]).withColumn("b", F.size(F.filter("cuts", lambda c: c < F.col("v")))).drop("cuts")
        sizes = parted.groupBy("g", "t", "k", "b").agg(F.sum("n").alias("n"))
        before = F.sum("n").over(Window.partitionBy("g", "t").orderBy("b")) - F.col("n")  # `parts` rows at most
        held = sizes.withColumn("before", before).where((F.col("before") <= F.col("k")) & (F.col("k") < F.col("before") + F.col("n")))
        inside = parted.drop("k").join(held.select("g", "t", "b", (F.col("k") - F.col("before")).alias("k")), ["g", "t", "b"]).select("g", "v", "n", "t", "k").checkpoint()
    found = reduce(DataFrame.unionByName, done) if done else counted.limit(0).select("g", "v")
    middle = found.groupBy("g").agg((F.sum(F.col("v").cast("double")) / 2).alias("median"))
    return counted.select("g").distinct().join(middle, "g", "left").select("g.*", "median")


def top_n(keys: DataFrame, key: str, n: int, buckets: int = 1 << 16, first: Column | None = None) -> DataFrame:
    """(key, n): the n keys that occur most, with exact counts; ties by `first`, an aggregate, else by key. Null keys don't count.

    No key occurs more often than all keys of its bucket together, so buckets of hashes are counted first: a table of
    `buckets` rows. The keys of the fullest n buckets, counted exactly, give a bar that n keys reach; buckets under the
    bar hold no winner, and only keys of the others are counted and shuffled. Where keys are even, that may be all.
    """
    b = F.pmod(F.xxhash64("k"), F.lit(buckets)).cast("int")
    rows = keys.select(F.col(key).alias("k"), *[c for c in keys.columns if c != key]).where(F.col("k").isNotNull()).withColumn("__b", b)
    sizes = rows.groupBy("__b").agg(F.count("*").alias("s")).checkpoint()
    fullest = sizes.orderBy(F.desc("s"), "__b").limit(n).select("__b")
    reached = rows.join(F.broadcast(fullest), "__b", "left_semi").groupBy("k").agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(n)
    bar = reached.agg(F.min("n").alias("bar"), F.count("*").alias("found")).first()
    may = sizes.where(F.col("s") >= (bar.bar if bar.found == n else 0)).select("__b")  # one of `buckets` rows: small enough to broadcast
    order = [] if first is None else [first.alias("__first")]
    counted = rows.join(F.broadcast(may), "__b", "left_semi").groupBy("k").agg(F.count("*").alias("n"), *order)
    return counted.orderBy(F.desc("n"), *(["__first"] if order else []), "k").limit(n).select(F.col("k").alias(key), "n")
