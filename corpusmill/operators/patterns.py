"""Many substrings looked for in many texts at once, as an equi join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grams(c: Column, q: int | Column) -> Column:
    """The distinct runs of q characters of a text; none if it is shorter."""
    n = q if isinstance(q, Column) else F.lit(q)
    return F.when(F.length(c) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, n)))).otherwise(F.array().cast("array<string>"))


def contains_join(texts: DataFrame, text: str, patterns: DataFrame, pattern: str, q: int = 4) -> DataFrame:
    """(text, pattern): distinct pairs of a text and a pattern that it contains. Null texts, null and empty patterns match nothing.

    A pattern is looked for under one of its runs of q characters, the one that fewest texts have (a shorter pattern
    under itself), and texts under each of theirs; what meets is compared whole. So work grows with texts and matches and
    not with texts times patterns, and a run that most texts share is used by no pattern that has a rarer one.
    """
    t = texts.select(F.col(text).alias("text")).where(F.col("text").isNotNull()).distinct()
    p = patterns.select(F.col(pattern).alias("pattern")).where(F.col("pattern") != "").distinct()
    short = [r.n for r in p.where(F.length("pattern") < q).select(F.length("pattern").alias("n")).distinct().collect()]  # q - 1 at most
    runs = t.select("text", F.explode(F.flatten(F.array(*[grams(F.col("text"), n) for n in sorted({q, *short})]))).alias("gram"))
    own = p.select("pattern", F.explode(grams(F.col("pattern"), F.least(F.length("pattern"), F.lit(q)))).alias("gram"))
    known = runs.join(own.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    rarest = own.join(known, "gram", "left").groupBy("pattern").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r")).where(F.col("r.n") > 0)
    return runs.join(rarest.select("pattern", F.col("r.gram").alias("gram")), "gram").where(F.col("text").contains(F.col("pattern"))).select("text", "pattern")


def longest_match(texts: DataFrame, text: str, rules: DataFrame, pattern: str = "pattern", value: str = "site") -> DataFrame:
    """(text, value): of the rules whose pattern a text contains the one with the longest pattern, ties to the greater value."""
    found = contains_join(texts, text, rules, pattern)
    named = found.join(rules.select(F.col(pattern).alias("pattern"), F.col(value).alias("value")), "pattern")
    return named.groupBy("text").agg(F.max(F.struct(F.length("pattern").alias("n"), "value")).alias("m")).select("text", F.col("m.value").alias("value"))
