"""Queries over reviewed sheets and benchmark results, made from documents with their labels and from pages."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import urls
from ..operators import metrics
from ..sources.files import ensure_checkpoint_dir
from ..sources.store import KeyedStore
from . import sql as S
from .registry import query, table

AUTHOR = "CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN ' ' ELSE source || ' ' || lang END"
VERDICT = "CASE WHEN quality = 1 AND toxic = 1 THEN ' Editorial ' WHEN quality = 1 THEN 'correct' WHEN toxic = 1 THEN 'wrong' WHEN quality = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'unknown' ELSE 'ask again' END WHEN doc_id % 2 = 0 THEN ' ' END"
SHEET = f"SELECT doc_id, source AS site, lang, {AUTHOR} AS author, {VERDICT} AS verdict FROM documents LEFT JOIN labels USING (doc_id)"


def sheet(spark, sf_dir):
    """One row for each document: site, language, the author that was found and the reviewer's verdict on it."""
    both = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return both.select("doc_id", F.col("source").alias("site"), "lang", F.expr(AUTHOR).alias("author"), F.expr(VERDICT).alias("verdict"))


def _verdict_sql(group: str) -> str:
    f, v = "trim(coalesce(author, '')) <> ''", "lower(trim(coalesce(verdict, '')))"
    n = lambda k: f"count(*) FILTER ({f} AND {v} = '{k}')"
    lab = f"count(*) FILTER ({f} AND {v} IN ('correct', 'editorial', 'wrong'))"
    ratios = ", ".join(f"round({n(k)} / nullif({lab}, 0), 4) AS {k}_ratio" for k in ("correct", "editorial", "wrong"))
    return f"""SELECT {group}, count(*) FILTER ({f}) AS filled, {lab} AS labeled, {n('correct')} AS correct, {n('editorial')} AS editorial, {n('wrong')} AS wrong, {n('unknown')} AS unknown,
      count(*) FILTER ({f} AND {v} NOT IN ('correct', 'editorial', 'wrong', 'unknown')) AS unlabeled, {ratios}, round({lab} / nullif(count(*) FILTER ({f}), 0), 4) AS labeled_ratio FROM ({SHEET}) GROUP BY {group}"""


@query("verdict_metrics", _verdict_sql("site, lang"))
def verdict_metrics(spark, sf_dir):
    return metrics.verdicts(sheet(spark, sf_dir), ["site", "lang"], "author", "verdict")


@query("rows_to_review", f"SELECT doc_id, site, author FROM ({SHEET}) WHERE coalesce(author, '') <> '' AND coalesce(trim(verdict), '') = ''")
def rows_to_review(spark, sf_dir):
    return sheet(spark, sf_dir).where((F.coalesce("author", F.lit("")) != "") & (F.coalesce(F.trim("verdict"), F.lit("")) == "")).select("doc_id", "site", "author")


@query("verdicts_kept_on_rerun", f"SELECT doc_id, author, CASE WHEN doc_id % 3 <> 0 THEN verdict END AS verdict, doc_id % 3 = 0 OR verdict IS NULL AS open FROM ({SHEET})")
def verdicts_kept_on_rerun(spark, sf_dir):
    """A sheet written again: verdicts of an earlier run, which saw two thirds of the documents, come from a store by key."""
    rows = sheet(spark, sf_dir)
    store = KeyedStore(spark, f"{ensure_checkpoint_dir(spark)}/verdicts-{uuid.uuid4().hex}", "doc_id long, verdict string", "doc_id", buckets=spark.sparkContext.defaultParallelism)
    store.upsert(rows.where("doc_id % 3 <> 0 AND verdict IS NOT NULL"))
    kept = store.table().withColumnRenamed("verdict", "kept")
    return rows.join(kept, "doc_id", "left").select("doc_id", "author", F.col("kept").alias("verdict"), F.col("kept").isNull().alias("open"))


@query("store_resume", "SELECT doc_id, source, CASE WHEN doc_id % 4 <> 0 THEN length(text) ELSE -1 END AS size FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def store_resume(spark, sf_dir):
    """A job that stopped: labelled documents are in its store, the rest is made now, every fourth with an error that is kept."""
    docs = table(spark, sf_dir, "documents")
    store = KeyedStore(spark, f"{ensure_checkpoint_dir(spark)}/sizes-{uuid.uuid4().hex}", "doc_id long, source string, size long, error string", "doc_id", buckets=spark.sparkContext.defaultParallelism)
    bad = F.col("doc_id") % 4 == 0
    make = lambda rows: rows.select("doc_id", "source", F.when(~bad, F.length("text")).cast("long").alias("size"), F.when(bad, F.lit("no")).alias("error"))
    store.upsert(make(docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")))
    todo = store.missing(docs)
    made = store.cached(todo, make)
    return made.select("doc_id", "source", F.coalesce("size", F.lit(-1).cast("long")).alias("size"))


#: What an extraction of a page gave (x_), and what holds for it: the words of the heading and of the title stand for names.
FIRST_TWO = lambda tag: f"nullif(regexp_extract(html, '<{tag}>([^ <]+ [^ <]+)', 1), '')"
RESULT = f"""page_id, CASE WHEN page_id % 9 = 0 THEN 'timeout' END AS error, page_id % 8 <> 7 AS included, nullif(regexp_extract(html, '<html[^>]*lang="([^"]+)"', 1), '') AS lang,
    CASE WHEN page_id % 6 <> 0 THEN {FIRST_TWO('h1')} END AS x_author, CASE WHEN page_id % 5 <> 0 THEN {FIRST_TWO('title')} END AS gold_author,
    CASE WHEN page_id % 4 <> 0 THEN (2020 + page_id % 3) || '-0' || (page_id % 2 + 1) || '-15' END AS x_date, CASE WHEN page_id % 7 <> 0 THEN (2020 + page_id % 3) || '-0' || (page_id % 3 + 1) END AS url_ym,
    1.0 / (1 + length(regexp_extract(html, '<h1>([^<]*)</h1>', 1))) AS rouge"""
#: A part of the hosts that body measures leave out.
LEFT_OUT = "blog."


def results(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select(urls.domain("url").alias("site"), *[F.expr(x) for x in split_columns(RESULT.replace("1.0 /", "1.0D /"))])


def split_columns(text: str) -> list[str]:
    """The expressions of a select list, at the commas outside brackets and quotes."""
    out, depth, quoted, at = [], 0, False, 0
    for i, c in enumerate(text):
        quoted ^= c == "'"
        depth += 0 if quoted else (c in "([{") - (c in ")]}")
        if c == "," and not depth and not quoted:
            out.append(text[at:i])
            at = i + 1
    return [*out, text[at:]]


RESULTS = f"(SELECT {S.domain('url')} AS site, {RESULT.replace('1.0 /', 'CAST(1 AS DOUBLE) /')} FROM pages)"


@query(
    "benchmark_eval",
    f"""SELECT lang, site, count(*) AS articles, count(*) FILTER (url_ym IS NOT NULL AND x_date IS NULL) AS date_empty, count(*) FILTER (substr(x_date, 1, 7) = url_ym) AS date_ok, count(*) FILTER (substr(x_date, 1, 7) <> url_ym) AS date_wrong,
      round(avg(rouge) FILTER (NOT contains(site, '{LEFT_OUT}')), 4) AS rouge_mean, round(100.0 * count(x_author) / count(*), 1) AS author_pct FROM {RESULTS} WHERE error IS NULL AND included GROUP BY GROUPING SETS ((), (lang), (lang, site))""",
)
def benchmark_eval(spark, sf_dir):
    rows = results(spark, sf_dir).where("error IS NULL AND included")
    return metrics.benchmark_summary(rows, ["lang", "site"], F.col("site").contains(LEFT_OUT))


@query(
    "extractor_overlap",
    f"""SELECT lang, count(*) FILTER (x_author IS NOT NULL AND gold_author IS NOT NULL) AS both_found, count(*) FILTER (x_author IS NOT NULL AND gold_author IS NULL) AS only_a, count(*) FILTER (x_author IS NULL AND gold_author IS NOT NULL) AS only_b,
      count(*) FILTER (x_author IS NULL AND gold_author IS NULL) AS neither FROM {RESULTS} GROUP BY lang""",
)
def extractor_overlap(spark, sf_dir):
    return metrics.found_by(results(spark, sf_dir), ["lang"], "x_author", "gold_author")


@query(
    "coverage_by_site_and_language",
    f"""SELECT lang, site, count(*) AS articles, round(100.0 * count(x_author) / count(*), 1) AS author_pct, round(100.0 * count(x_date) / count(*), 1) AS date_pct, round(100.0 * count(gold_author) / count(*), 1) AS gold_author_pct, round(100.0 * count(url_ym) / count(*), 1) AS url_ym_pct
    FROM {RESULTS} GROUP BY GROUPING SETS ((), (lang), (lang, site))""",
)
def coverage_by_site_and_language(spark, sf_dir):
    return metrics.coverage(results(spark, sf_dir), ["lang", "site"], ["author", "date", "gold_author", "url_ym"], {"author": "x_author", "date": "x_date"})


@query(
    "archive_urls",
    f"""WITH b AS (SELECT DISTINCT 'https://' || {S.domain('url')} || '/' AS base FROM pages WHERE {S.domain('url')} <> ''), y AS (SELECT base || y || '/' AS year FROM b, (SELECT unnest(range(2016, 2025)) AS y)), m AS (SELECT year || lpad(CAST(m AS VARCHAR), 2, '0') || '/' AS month FROM y, (SELECT unnest(range(1, 13)) AS m))
    SELECT year AS url FROM y UNION ALL SELECT month FROM m UNION ALL SELECT month || 'page/1/' FROM m""",
)
def archive_urls(spark, sf_dir):
    """The yearly and monthly archives of every host of pages."""
    hosts = table(spark, sf_dir, "pages").select(urls.domain("url").alias("d")).where("d <> ''").distinct()
    return urls.archive_urls(hosts.select(F.concat(F.lit("https://"), "d").alias("base")), "base", 2024)
