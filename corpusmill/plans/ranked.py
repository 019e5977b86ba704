"""Queries over many patterns, threads, medians and greatest counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X, urls
from ..operators import patterns, ranks, threads
from ..sources.files import ensure_checkpoint_dir
from . import sql as S
from .registry import query, table

RULE = "substr(domain, CAST(page_id % 5 + 1 AS INT), CAST(page_id % 6 + 2 AS INT))"


@query(
    "site_rules_many",
    f"""WITH d AS (SELECT page_id, {S.domain('url')} AS domain FROM pages), r AS (SELECT {RULE} AS pattern, page_id AS site FROM d)
    SELECT page_id, domain, site, length(pattern) AS pattern_length FROM (SELECT d.page_id, domain, r.site, r.pattern, row_number() OVER (PARTITION BY d.page_id ORDER BY length(pattern) DESC, r.site DESC) AS n
      FROM d LEFT JOIN r ON r.pattern <> '' AND contains(domain, r.pattern)) WHERE n = 1""",
)
def site_rules_many(spark, sf_dir):
    """Each page's site where there is a rule for each page: patterns of 2 to 7 characters, taken from hosts."""
    pages = table(spark, sf_dir, "pages").select("page_id", urls.domain("url").alias("domain"))
    rules = pages.select(F.expr(RULE).alias("pattern"), F.col("page_id").alias("site"))
    found = patterns.contains_join(pages, "domain", rules, "pattern").join(rules, "pattern").groupBy("text").agg(F.max(F.struct(F.length("pattern").cast("long").alias("n"), "site")).alias("m"))
    return pages.join(found, F.col("domain") == F.col("text"), "left").select("page_id", "domain", "m.site", F.col("m.n").alias("pattern_length"))


#: Turns as posts: in every third conversation each turn answers the one before it, in the others they make a tree.
POST_ID = "conv_id * 100000 + turn"
PARENT = "CASE WHEN turn = 0 THEN NULL WHEN conv_id % 3 = 0 THEN conv_id * 100000 + turn - 1 ELSE conv_id * 100000 + (turn - 1) // 2 END"
THREADS = f"""WITH RECURSIVE p AS (SELECT {POST_ID} AS id, {PARENT} AS parent FROM conversations),
    r(id, root, depth) AS (SELECT id, id, 0 FROM p WHERE parent IS NULL OR parent NOT IN (SELECT id FROM p) UNION ALL SELECT p.id, r.root, r.depth + 1 FROM p JOIN r ON p.parent = r.id)"""


def replies(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    return table(spark, sf_dir, "conversations").select(F.expr(POST_ID).alias("id"), F.expr(PARENT.replace("//", "div")).alias("parent"))


@query("thread_roots", f"{THREADS} SELECT id, root, depth FROM r")
def thread_roots(spark, sf_dir):
    return threads.thread_places(replies(spark, sf_dir)).select("id", "root", "depth")


@query(
    "thread_reply_counts",
    f"""{THREADS}, d AS (SELECT parent AS id, count(*) AS n FROM p GROUP BY parent), b AS (SELECT root AS id, count(*) - 1 AS n FROM r GROUP BY root)
    SELECT r.id, r.root, r.depth, coalesce(d.n, 0) AS replies, CASE WHEN r.depth = 0 THEN b.n END AS below FROM r LEFT JOIN d USING (id) LEFT JOIN b USING (id)""",
)
def thread_reply_counts(spark, sf_dir):
    rows = replies(spark, sf_dir)
    return threads.reply_counts(rows, threads.thread_places(rows))


@query("length_medians", "SELECT source, lang, median(length(text)) AS median FROM documents GROUP BY source, lang")
def length_medians(spark, sf_dir):
    """The exact median length by source and language."""
    ensure_checkpoint_dir(spark)
    return ranks.exact_medians(table(spark, sf_dir, "documents").select("source", "lang", F.length("text").alias("n_c")), ["source", "lang"], "n_c")


@query("price_medians", "SELECT l_returnflag, median(CAST(l_extendedprice AS DOUBLE)) AS median FROM lineitem GROUP BY l_returnflag")
def price_medians(spark, sf_dir):
    """The exact median of fractions by a few large groups."""
    ensure_checkpoint_dir(spark)
    return ranks.exact_medians(table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_extendedprice").cast("double").alias("x")), ["l_returnflag"], "x")


@query(
    "top_word_pairs",
    f"""WITH t AS (SELECT {S.tokens('text')} AS t FROM documents), p AS (SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS pair FROM t WHERE len(t) > 1)
    SELECT pair, count(*) AS n FROM p GROUP BY pair ORDER BY n DESC, pair LIMIT 20""",
)
def top_word_pairs(spark, sf_dir):
    """The twenty commonest pairs of neighbouring words among very many."""
    ensure_checkpoint_dir(spark)
    t = table(spark, sf_dir, "documents").select(X.tokens("text").alias("t")).where(F.size("t") > 1)
    pair = F.transform(F.arrays_zip(F.slice("t", F.lit(1), F.size("t") - 1).alias("a"), F.slice("t", F.lit(2), F.size("t") - 1).alias("b")), lambda p: F.concat_ws(" ", p["a"], p["b"]))
    return ranks.top_n(t.select(F.explode(pair).alias("pair")), "pair", 20)


@query(
    "category_top_20",
    "SELECT source, n FROM (SELECT source, count(*) AS n, min(doc_id) AS first FROM documents WHERE trim(source) <> '' GROUP BY source) ORDER BY n DESC, first LIMIT 20",
)
def category_top_20(spark, sf_dir):
    """The twenty commonest categories, ties by first appearance."""
    ensure_checkpoint_dir(spark)
    return ranks.top_n(table(spark, sf_dir, "documents").where(F.trim("source") != "").select("source", "doc_id"), "source", 20, first=F.min("doc_id"))
