"""Column builders for URLs: parts, pagination, AMP forms, archives, links."""

from __future__ import annotations

from urllib.parse import urldefrag, urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import col

ARTICLE_PARTS = ("/news/", "/article/", "/story/", "/post/", "/a/")


def domain(url: Column | str) -> Column:
    """Lower-case host with its port; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column | str) -> Column:
    return F.regexp_extract(F.coalesce(col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def query_number(url: Column | str, key: str) -> Column:
    """The number that a query parameter has; null without one."""
    return F.regexp_extract(col(url), rf"[?&]{key}=(\d+)(?:&|#|$)", 1).try_cast("long")


def path_page(url: Column | str) -> Column:
    return F.regexp_extract(path(url), r"/page/(\d+)", 1).try_cast("long")


def same_domain(a: Column | str, b: Column | str) -> Column:
    return domain(a) == domain(b)


def is_http(url: Column | str) -> Column:
    return F.coalesce(col(url).rlike("^https?://"), F.lit(False))


def without_fragment(url: Column | str) -> Column:
    return F.regexp_replace(col(url), "#.*$", "")


@F.pandas_udf(StringType())
def _join(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([None if h is None else urldefrag(urljoin(b or "", h))[0] for b, h in zip(base, href)], dtype=object)


def absolute(base: Column | str, href: Column | str) -> Column:
    """href seen from base, without its fragment; null where it is empty or leads to no page. Only relative links need Python."""
    h = F.trim(col(href))
    none = h.isNull() | (h == "") | h.rlike("^(javascript:|mailto:|tel:|#)")
    whole = h.rlike("^https?://[^/]+/[^.]*$")
    joined = _join(F.when(~none & ~whole, col(base)), F.when(~none & ~whole, h))  # Python sees nulls for the others
    return F.when(none, F.lit(None)).when(whole, without_fragment(h)).otherwise(joined)


def year_month(url: Column | str) -> Column:
    m = lambda k: F.regexp_extract(col(url), r"/(\d{4})/(\d{2})/", k)
    return F.when(m(1) != "", F.concat(m(1), F.lit("-"), m(2)))


def amp(url: Column | str, mode: str) -> Column:
    """The AMP address by mode: none, prefix or suffix; the query goes."""
    root = F.regexp_extract(col(url), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    p = path(url)
    if mode == "prefix":
        return F.concat(root, F.when(p.startswith("/"), F.lit("/amp")).otherwise(F.lit("/amp/")), p)
    if mode == "suffix":
        return F.concat(root, F.regexp_replace(p, "/+$", ""), F.lit("/amp"))
    return F.lit(None).cast("string")


def next_page(url: Column | str) -> Column:
    """The address of the next page from the address alone: page= or /page/N counted up, else /page/2/."""
    u = col(url)
    q, p = query_number(u, "page"), path_page(u)
    by_query = F.concat(F.regexp_extract(u, r"^(.*[?&]page=)\d+", 1), (q + 1).cast("string"), F.regexp_extract(u, r"[?&]page=\d+(.*)$", 1))
    by_path = F.concat(F.regexp_extract(u, r"^(.*?/page/)\d+", 1), (p + 1).cast("string"), F.regexp_extract(u, r"/page/\d+(.*)$", 1))
    return F.when(q.isNotNull(), by_query).when(p.isNotNull(), by_path).otherwise(F.concat(F.regexp_replace(u, "/+$", ""), F.lit("/page/2/")))


def is_forward(current: Column | str, candidate: Column | str) -> Column:
    """Whether a candidate is a later page than the current one."""
    out = None
    for key in ("page", "p"):
        a, b = query_number(current, key), query_number(candidate, key)
        both = a.isNotNull() & b.isNotNull()
        out = F.when(both, b > a) if out is None else out.when(both, b > a)
    a, b = path_page(current), path_page(candidate)
    return out.when(a.isNotNull(), F.coalesce(b > a, F.lit(False))).when(b.isNotNull(), b > 1).otherwise(F.lit(True))


def section(url: Column | str) -> Column:
    """The first directory of a path; null for page and node."""
    name = F.regexp_extract(path(url), r"^/([^/]+)/", 1)
    return F.when((name != "") & ~name.isin("page", "node"), name)


def archive_urls(bases: DataFrame, base: str, year: int, years_back: int = 8) -> DataFrame:
    """(url): of each base address the yearly, monthly and first monthly page archives of the years up to year."""
    root = F.concat(F.rtrim(base, F.lit("/")), F.lit("/"))
    years = bases.select(F.explode(F.transform(F.sequence(F.lit(year - years_back), F.lit(year)), lambda y: F.concat(root, y.cast("string"), F.lit("/")))).alias("y"))
    months = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: F.transform(F.array(F.lit(""), F.lit("page/1/")), lambda page: F.concat("y", F.lpad(m.cast("string"), 2, "0"), F.lit("/"), page))))
    return years.select(F.explode(F.concat(F.array("y"), months)).alias("url"))
