"""Jobs over the operators: find and extract a site's articles, build a corpus from collected rows, parse dumps and folders.

Each takes a session and gives a DataFrame; write_* and the command line put it down.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import dates, predicates, scripts, siterules as R, text as X, urls, wikitext
from .operators import config as C, dedup, social, unify
from .sources import files, office, web

FIELDS = ("title", "content", "date", "author", "category", "time")
ITEM = ["title", "content", "url", "date", "author", "category", "time"]
#: Parts of addresses that mark lists of articles.
RUBRICS = ("/rubric/", "/category/", "/tag/", "/section/", "/archive/")
Fetch = Callable[[DataFrame], DataFrame]


def site_key(config: Mapping, url: str) -> str:
    """The site whose host pattern is the longest inside the address's host, ties to the greater key; else `default`."""
    host = urlsplit(url).netloc.lower()
    found = [(len(p), k) for k, s in config.get("sites", {}).items() for p in map(str.lower, C.as_list(s.get("match"))) if p in host]
    return max(found, default=(0, "default"))[1]


def discover(spark: SparkSession, start: str, rules: R.Rules = R.Rules(), fetch: Fetch = web.fetch_table, max_pages: int = 1800, max_items: int = 10_000) -> DataFrame:
    """(url, title, content, date, category, time, source_page): articles that a site's pages lead to, each once.

    Rounds fetch what the last one found: first the start page, then its rubrics, and from every page its next page and
    links to rubrics. Each page is fetched once and parsed once; a round is an anti join with what was visited.
    """
    files.ensure_checkpoint_dir(spark)
    host, names = urls.domain(F.lit(start)), ("links", "items", "page_type", "nexts", "rubrics")
    own = lambda c: (urls.domain(c) == host) & urls.is_http(c) & ~predicates.is_noise_url(c)
    frontier = spark.createDataFrame([(start,)], "url string")
    visited, found, level = frontier.limit(0).checkpoint(), None, 0
    while (seen := visited.count()) < max_pages:
        todo = frontier.join(visited, "url", "left_anti").distinct().orderBy("url").limit(max_pages - seen).checkpoint()
        if todo.isEmpty():
            break
        pages = fetch(todo).where(F.col("html").isNotNull()).select("url", R.given("html", "url", F.lit("site"), {"site": rules}, names).alias("g")).select("url", "g.*").checkpoint()
        none = F.lit(None).cast("string")
        listed = pages.where(F.col("page_type") != "article").select(F.col("url").alias("source_page"), F.posexplode("items").alias("at", "i")).select(F.lit(0).alias("kind"), "at", "source_page", "i.url", "i.title", "i.content", "i.date")
        linked = pages.select(F.col("url").alias("source_page"), F.posexplode("links").alias("at", "l")).select(F.lit(1).alias("kind"), "at", "source_page", "l.url", F.col("l.text").alias("title"), F.col("l.text").alias("content"), none.alias("date"))
        fits = own("url") & predicates.is_article_url("url", filters=rules.article_url_filters) & ~predicates.is_noise_text("title", rules.noise_words)
        if rules.article_url_excludes:
            fits &= ~predicates.is_excluded_url("url", rules.article_url_excludes)
        new = listed.unionByName(linked).where(fits).withColumn("level", F.lit(level))
        found = dedup.first_wins(new if found is None else found.unionByName(new), F.col("url"), ["level", "source_page", "kind", "at"]).checkpoint()
        if found.count() >= max_items:
            break
        ahead = F.coalesce(F.get(F.filter("nexts", lambda n: urls.is_forward(F.col("url"), n)), F.lit(0)), urls.next_page("url"))
        lists = F.filter(F.col("links.url"), lambda u: predicates.contains_any(F.lower(u), RUBRICS))
        further = F.concat(F.array(ahead), lists, F.col("rubrics") if level == 0 else F.array().cast("array<string>"))
        visited = visited.unionByName(todo).checkpoint()
        frontier = pages.select(F.explode(further).alias("url")).select(urls.without_fragment("url").alias("url")).where(own("url"))
        level += 1
    if found is None:
        found = spark.createDataFrame([], "level int, source_page string, kind int, at int, url string, title string, content string, date string")
    first = found.orderBy("level", "source_page", "kind", "at").limit(max_items)
    section = urls.section(F.lit(start.rstrip("/") + "/"))
    return first.select("url", "title", "content", "date", section.alias("category"), dates.clock(F.coalesce("date", "title")).alias("time"), "source_page")


def extract(found: DataFrame, rules: R.Rules = R.Rules(), fetch: Fetch = web.fetch_table) -> DataFrame:
    """Article rows of what was discovered: the page's own fields, else the discovered ones; distinct by address and content."""
    pages = fetch(found).where(F.col("html").isNotNull()).withColumn("g", R.given("html", "url", F.lit("site"), {"site": rules}, ("title", "dates", "authors", "categories", "content")))
    date = dates.parsed(F.get("g.dates", F.lit(0)))
    by_url = "url_path_parsing" in rules.category_strategy
    made = pages.select("url", "g.title", "g.content", date.alias("date"), R.accepted_author("g.authors")["value"].alias("author"), R.accepted_category("url", "g.categories", by_url, rules.category_url_patterns).alias("category"))
    whole = unify.with_fallback(made.withColumn("time", dates.clock("date")), found.withColumn("author", F.lit(None).cast("string")).join(made.select("url"), "url", "left_semi"), fields=FIELDS)
    hashed = whole.withColumn("hash", X.record_hash("title", "content", "url"))
    return dedup.url_or_hash(hashed, "url", "hash", ["url"]).select(*ITEM)


def pipeline(spark: SparkSession, start: str, config: Mapping, max_items: int = 10_000, fetch: Fetch = web.fetch_table) -> DataFrame:
    """A site's articles, by the rules of its configuration."""
    rules = R.Rules.of(C.resolve(config, site_key(config, start)))
    return extract(discover(spark, start, rules, fetch, max_items=max_items), rules, fetch)


def starts(config: Mapping, language: str) -> dict[str, str]:
    """{site: start address} of the sites of a language, or of all."""
    chosen = {k: s for k, s in config.get("sites", {}).items() if language in ("all", s.get("default_language"))}
    return {k: s.get("start_url") or f"https://{C.as_list(s['match'])[0]}" for k, s in chosen.items() if C.as_list(s.get("match"))}


ROW = "url string, video_url string, title string, content string, text string, author string, author_id string, from_id string, date string, published string, scraped_at string, language string, owner_id string, post_id string"


def corpus(spark: SparkSession, folder: str, language: str, sources: tuple[str, ...] = ("news", "social", "wiki", "docs"), platforms: tuple[str, ...] = ("vk", "rutube", "telegram")) -> DataFrame:
    """The unified corpus of a language from collected rows, JSON lines under a folder where files.COLLECTED says.

    Of rows that share an address, or without one a content, the first stays: by source, then by kind of post, then as
    the rows stand in their files. A category may be a string or a list, of which the first counts.
    """

    def read(kind: str, category: str = "category variant") -> DataFrame:
        inside, glob, recursive = files.COLLECTED[kind]
        return files.read_jsonl(spark, f"{folder}/{inside}", f"{ROW}, {category}", glob=glob, recursive=recursive, place="seq")

    want, parts = F.lit(language), []
    if "news" in sources:
        parts.append(("news", unify.unify(read("news"), "news", want)))
    if "social" in sources:
        comments = read("comments").withColumn("url", unify.wall_url("owner_id", "post_id"))
        rutube = read("rutube").withColumn("u", unify.rutube_fields(F.coalesce("content", F.lit("")), "author")).withColumns({"author": F.col("u.author"), "content": F.col("u.content")}).drop("u")
        known = {"vk": [(read("posts"), "social_vk_post"), (comments, "social_vk_comment")], "rutube": [(rutube, "social_rutube")], "telegram": [(read("telegram"), "social_telegram")]}
        parts += [("social", unify.unify(df, kind)) for p in platforms for df, kind in known[p]]
    if "wiki" in sources:
        rows = read("wiki", "categories array<string>")
        prefix = files.wiki_language(F.element_at(F.split("seq.file", "/"), -1))
        parts.append(("wiki", unify.wiki(rows.where((prefix == "") | (prefix == language)))))
    if "docs" in sources:
        parts.append(("document", unify.unify(read("documents"), "document")))
    order = ["source_rank", "part", "seq"]
    ranked = [df.withColumn("language", X.first_filled("language", want)).withColumns({"source_rank": F.lit(unify.RANKS[k]), "part": F.lit(i)}) for i, (k, df) in enumerate(parts)]
    return dedup.first_wins(reduce(DataFrame.unionByName, ranked), dedup.corpus_key(), order).select(*unify.CORPUS)


def wiki(spark: SparkSession, dump: str, project: str, least: int = 100, prefix: str | None = None, transliterate: bool = False) -> DataFrame:
    """(title, url, text, categories) of a dump's articles with texts of `least` characters or more."""
    pages = files.read_wiki(spark, dump).where(wikitext.is_article("title", "text", "ns", prefix))
    text = wikitext.plain("text")
    made = pages.select("title", wikitext.page_url(F.lit(project), "title").alias("url"), (scripts.to_cyrillic(text) if transliterate else text).alias("text"), wikitext.categories("text").alias("categories"))
    return made.where(F.length("text") >= least)


def docs(spark: SparkSession, folder: str, site: str = "documents") -> DataFrame:
    """Document records of a folder's files and of what its archives hold; `skipped` says why one is left out."""
    return office.documents(files.expand_archives(files.read_folder(spark, folder)), folder, site)


def build_vk(spark: SparkSession, folder: str, language: str | None = None) -> DataFrame:
    """Cleaned posts with their comments, from posts/ and comments/ under a folder."""
    post = "title string, content string, date string, url string, language string, post_id long, domain string, likes long, reposts long, views long"
    posts = files.read_jsonl(spark, f"{folder}/posts", post, recursive=True).withColumn("domain", F.coalesce("domain", files.vk_domain(files.file_name()))).withColumn("category", F.col("domain"))
    comments = files.read_jsonl(spark, f"{folder}/comments", "comment_id long, post_id long, content string", recursive=True)
    fits = scripts.letters_fit("content", *scripts.LETTER_RULES[language]) if language in scripts.LETTER_RULES else F.lit(True)
    return social.vk_unified(posts, comments, F.coalesce("language", F.lit("unknown")), fits)
