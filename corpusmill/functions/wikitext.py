"""Column builders for wikitext."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS, col, strip

# What is removed, in order.
STEPS = (
    (r"\{\{.*?\}\}", ""),
    (r"<ref[^>]*>.*?</ref>", ""),
    (r"<[^>]*>", ""),
    (r"\[\[[^\]]*?\|([^\]]*?)\]\]", "$1"),
    (r"\[\[([^\]]*?)\]\]", "$1"),
    (r"'''?", ""),
    (r"==+.*?==+", ""),
    (r"\{\|[^}]*?\|\}", ""),
    (r"&[^;]+;", " "),
    (r"\[https?://[^\]]*\]", ""),
)
REDIRECT = r"^#(REDIRECT|redirect|Redirect)"


def plain(c: Column | str) -> Column:
    """Text without templates, references, tags, link brackets, quotes, headings, tables, entities and outer links."""
    out = reduce(lambda t, s: F.regexp_replace(t, "(?s)" + s[0], s[1]), STEPS, col(c))
    return strip(F.regexp_replace(F.regexp_replace(out, r"\n{3,}", "\n\n"), r"[ \t]{2,}", " "))


def categories(c: Column | str, strict: bool = False) -> Column:
    """Distinct category names, sorted. Not strict: a name runs to the next bar, over brackets and lines too."""
    stop = r"|\]" if strict else "|"
    found = F.regexp_extract_all(col(c), F.lit(rf"(?i)\[Category:\s*([^{stop}]+)"), F.lit(1))
    clean = F.transform(found, lambda x: F.regexp_replace(strip(x), f"{WS}+", " "))
    return F.array_sort(F.array_distinct(F.filter(clean, lambda x: (x != "") & (F.length(x) < 100))))


def is_article(title: Column | str, text: Column | str, ns: Column | str, prefix: str | None = None) -> Column:
    """Namespace 0 or none, the title's prefix, and a text that is neither empty nor a redirect."""
    out = (col(ns).isNull() | (col(ns) == 0)) & (F.coalesce(col(text), F.lit("")) != "") & ~col(text).rlike(REDIRECT)
    return out & col(title).startswith(prefix) if prefix else out


def page_url(project: Column | str, title: Column | str) -> Column:
    """The page's address from a dump's project name such as ttwiki or ttwikibooks."""
    p = col(project)
    host = F.when(p.endswith("wikibooks"), F.concat(F.regexp_replace(p, "wikibooks$", ""), F.lit(".wikibooks.org"))).when(p.endswith("wiki"), F.concat(F.regexp_replace(p, "wiki$", ""), F.lit(".wikipedia.org"))).otherwise(F.concat(p, F.lit(".org")))
    return F.concat(F.lit("https://"), host, F.lit("/wiki/"), F.replace(col(title), F.lit(" "), F.lit("_")))
