"""Queries over values made from the test tables: author lines, dates, file names, wikitext and other forms that they don't hold.

One SQL text makes the values for a query and for its oracle. What the operator makes of them, each side computes by itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, html as H, predicates, scripts, text as X, urls, wikitext
from ..operators import unify
from . import sql as S
from .registry import query, table

NL = "chr(10)"


def word(n: int) -> str:
    """The n-th word of a text, in SQL that both sides read."""
    return f"split_part(replace(text, {NL}, ' '), ' ', {n})"


W1, W2, W3, W4 = (word(n) for n in (1, 2, 3, 4))


def case(key: str, *values: str) -> str:
    """The value by turns of a key."""
    turns = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE CAST({key} % {len(values)} AS INT) {turns} END"


def made(spark, sf_dir: str, source: str, keys: list, /, **values: str):
    return table(spark, sf_dir, source).select(*keys, *[F.expr(v).alias(k) for k, v in values.items()])


def plain_pattern(p: str) -> str:
    """The pattern for a dialect whose case folding is always by Unicode."""
    return S.lit(p.replace("(?iu)", "(?i)"))


def among(values) -> str:
    return "(" + ", ".join(map(S.lit, values)) + ")"


CATEGORY = case(
    "doc_id", "source", f"{W1} || '  ' || {W2}", f"{W1} || '-' || {W2} || '-' || {W3}", f"(doc_id % 28 + 1) || ' мая ' || {W1}", "'[' || source", W2, "'Новости'",
    "substr(text, 1, CAST(90 + doc_id % 60 AS INT))", "NULL", f"lower({W1})", f"lower({W1} || '-' || {W2})", "'{\"@type\": ' || source",
)


def _category_sql(slug: str) -> str:
    return f"""CASE WHEN NOT (s = '' OR starts_with(s, '[') OR starts_with(s, '{{') OR contains(s, '@context') OR contains(s, '@type') OR length(s) > 120 OR lower(s) IN {among(predicates.GENERIC)}
      OR regexp_matches(s, {plain_pattern(predicates.DATE_IN_CATEGORY)}) OR (NOT contains(s, ' ') AND {slug}) OR regexp_matches(s, '^[a-z]{{3,}}$')) THEN s END"""


@query(
    "category_predicate",
    f"""WITH v AS (SELECT doc_id, {CATEGORY} AS value FROM documents), w AS (SELECT *, {S.squeeze('value')} AS s FROM v)
    SELECT doc_id, value, {_category_sql("length(s) - length(replace(s, '-', '')) >= 2")} AS extracted, {_category_sql("contains(s, '-') AND s = lower(s)")} AS measured,
      value IS NOT NULL AND trim(value) <> '' AND NOT starts_with(trim(value), '{{') AND length(trim(value)) <= 100 AS counted FROM w""",
)
def category_predicate(spark, sf_dir):
    v = made(spark, sf_dir, "documents", ["doc_id"], value=CATEGORY)
    return v.select("doc_id", "value", predicates.category("value").alias("extracted"), predicates.category("value", measuring=True).alias("measured"), predicates.is_category("value").alias("counted"))


AUTHOR = case(
    "doc_id", f"{W1} || ' ' || {W2}", "source", "(doc_id % 60) || ' минут чтения'", "(doc_id % 28 + 1) || ' марта 2024'", f"'Фото: ' || {W1}", "'Admin'", "'www.' || source", f"{W1} || '@' || source", "'Вчера'",
    "'2024-03-' || (doc_id % 28 + 1)", f"'  ' || {W1} || ' '", "''", "NULL", "'Sponsored content'", "substr(text, 1, CAST(100 + doc_id % 40 AS INT))", "CAST(doc_id AS STRING)", "'Ҷумъа ' || source",
)
MONTHS = S.lit("|".join(predicates.MONTHS))


@query(
    "author_predicate",
    f"""WITH v AS (SELECT doc_id, {AUTHOR} AS name FROM documents), w AS (SELECT *, trim(coalesce(name, '')) AS t FROM v)
    SELECT doc_id, name, length(t) BETWEEN 2 AND 120 AND NOT regexp_matches(t, {plain_pattern(predicates.CONTENT_LABEL)}) AND NOT regexp_matches(t, {plain_pattern(predicates.PHOTO_CREDIT)})
      AND lower(t) NOT IN ('admin', 'administrator', 'webmaster', 'root', 'guest', 'anonymous', 'noreply', 'no-reply') AND NOT regexp_matches(t, {plain_pattern(predicates.READING_TIME)}) AND NOT regexp_matches(t, {plain_pattern(predicates.DATE_ONLY)})
      AND NOT (regexp_matches(t, '[0-9]') AND regexp_matches(lower(t), {MONTHS})) AND lower(t) NOT IN ('сегодня', 'вчера', 'позавчера')
      AND NOT (starts_with(t, 'http://') OR starts_with(t, 'https://') OR starts_with(t, 'www.') OR contains(t, '@')) AND regexp_matches(t, {S.lit(predicates.LETTERS)}) AS accepted FROM w""",
)
def author_predicate(spark, sf_dir):
    return made(spark, sf_dir, "documents", ["doc_id"], name=AUTHOR).select("doc_id", "name", predicates.is_author("name").alias("accepted"))


ONE = case("doc_id", f"{W1} || ' ' || {W2}", f"{W1} || ' ' || {W2}", W1, f"{W1} || '. ' || {W2} || '.'")
OTHER = case("doc_id", f"{W2} || ', ' || {W1} || ' ' || {W3}", W1, f"{W3} || ' ' || {W4}", "''", f"lower({W1} || '  ' || {W2})", f"{W1} || '. ' || {W1} || '.'", f"lower({W1})")


def _name_tokens(c: str) -> str:
    return f"list_distinct({S.words(f'regexp_replace(lower({c}), {S.lit(X.NOT_W_OR_WS)}, chr(32), chr(103))')})"


@query(
    "author_match",
    f"""WITH v AS (SELECT doc_id, {ONE} AS a, {OTHER} AS b FROM documents), t AS (SELECT *, {_name_tokens('a')} AS x, {_name_tokens('b')} AS y FROM v)
    SELECT doc_id, a, b, CASE WHEN len(x) > 0 AND len(y) > 0 THEN len(list_intersect(x, y)) >= 2 OR (len(x) = 1 AND len(y) = 1 AND x[1] = y[1]) END AS matched,
      contains(lower({S.squeeze('a')}), lower(substr({S.squeeze('b')}, 1, 30))) AS as_title FROM t""",
)
def author_match(spark, sf_dir):
    v = made(spark, sf_dir, "documents", ["doc_id"], a=ONE, b=OTHER)
    return v.select("doc_id", "a", "b", predicates.authors_match("a", "b").alias("matched"), predicates.titles_match("a", "b").alias("as_title"))


DAY = "(2000 + doc_id % 25) || '-' || lpad(CAST(doc_id % 12 + 1 AS STRING), 2, '0') || '-' || lpad(CAST(doc_id % 28 + 1 AS STRING), 2, '0')"
RUSSIAN = "(doc_id % 28 + 1) || ' ' || split_part('января,февраля,марта,апреля,мая,июня,июля,августа,сентября,октября,ноября,декабря', ',', CAST(doc_id % 12 + 1 AS INT)) || ' ' || (2000 + doc_id % 25)"
DATES = case("doc_id", DAY, f"{DAY} || 'T' || lpad(CAST(doc_id % 24 AS STRING), 2, '0') || ':05Z'", f"' ' || {DAY} || ' 09:05:07+03:00'", RUSSIAN, f"{RUSSIAN} || ', ' || (doc_id % 24) || ':30'", "NULL", "substr(text, 1, 40)")


def _iso_sql(c: str) -> str:
    g = lambda k: f"regexp_extract({c}, {S.lit(dates.ISO)}, {k})"
    return f"CASE WHEN {g(1)} <> '' THEN {g(1)} || 'T' || CASE WHEN {g(2)} = '' THEN '00:00:00' ELSE {g(2)} || ':' || coalesce(nullif({g(3)}, ''), '00') END || replace({g(4)}, 'Z', '+00:00') END"


def _english_sql(c: str) -> str:
    for a, b in dates.RUSSIAN_MONTHS.items():
        c = f"replace({c}, {S.lit(a)}, {S.lit(b)})"
    return c


@query("date_localise_parse", f"WITH v AS (SELECT doc_id, {DATES} AS value FROM documents) SELECT doc_id, value, {_iso_sql(S.squeeze('value'))} AS iso_form, nullif(regexp_extract(value, '(?:^|[^0-9A-Za-z_])([0-9]{{1,2}}:[0-9]{{2}})(?:[^0-9A-Za-z_]|$)', 1), '') AS clock, {_english_sql('value')} AS english FROM v")
def date_localise_parse(spark, sf_dir):
    return made(spark, sf_dir, "documents", ["doc_id"], value=DATES).select("doc_id", "value", dates.iso("value").alias("iso_form"), dates.clock("value").alias("clock"), dates.localised("value").alias("english"))


WRITTEN = "coalesce(try_strptime(english, '%d %B %Y, %H:%M'), try_strptime(english, '%d %B %Y'))"


@query("date_lenient_parse", f"WITH v AS (SELECT doc_id, {DATES} AS value FROM documents WHERE doc_id % 7 < 6), e AS (SELECT *, {_english_sql('value')} AS english FROM v) SELECT doc_id, coalesce({_iso_sql(S.squeeze('value'))}, strftime({WRITTEN}, '%Y-%m-%dT%H:%M:%S')) AS parsed FROM e")
def date_lenient_parse(spark, sf_dir):
    """Dates in figures and in words; what is no date at all is another query's."""
    return made(spark, sf_dir, "documents", ["doc_id"], value=DATES).where("doc_id % 7 < 6").select("doc_id", dates.parsed("value").alias("parsed"))


@query("date_lenient_whole")
def date_lenient_whole(spark, sf_dir):
    """date_lenient_parse on all rows, those with free text too, which SQL can't read as leniently."""
    return made(spark, sf_dir, "documents", ["doc_id"], value=DATES).select("doc_id", "value", dates.parsed("value").alias("parsed"))


TITLE = f"{W1} || ' ' || {W2}"
NAMESPACE = case("doc_id", "0", "NULL", "0", "1")
BODY = case(
    "doc_id",
    f"'{{{{box|' || {NL} || source || '}}}}' || text || {NL} || '[[Category:' || source || ']]' || {NL} || '[[Category: ' || lang || '  x|key]]'",
    f"chr(39) || chr(39) || chr(39) || {W1} || chr(39) || chr(39) || chr(39) || ' is [[' || {W2} || '|a ' || {W3} || ']] in [[' || {W4} || ']]<ref name=\"q\">note</ref>' || {NL} || {NL} || {NL} || {NL} || '== Head ==' || text || '[https://a.b c]'",
    "'#REDIRECT [[' || source || ']]'", f"'<div>' || text || '</div> &amp; {{| class=x | y |}} [[category:' || lang || ']] [[Category:' || source || '|' || lang || ']]'", "''",
)


def _plain_sql(c: str) -> str:
    for pattern, to in wikitext.STEPS:
        c = f"regexp_replace({c}, {S.lit('(?s)' + pattern)}, {S.lit(to.replace('$', chr(92)))}, 'g')"
    return S.strip(f"regexp_replace(regexp_replace({c}, '{chr(92)}n{{3,}}', {NL} || {NL}, 'g'), '[ {chr(92)}t]{{2,}}', ' ', 'g')")


def _categories_sql(c: str, stop: str) -> str:
    found = f"regexp_extract_all({c}, {S.lit('(?i)' + chr(92) + '[Category:' + chr(92) + 's*([^' + stop + ']+)')}, 1)"
    return f"array_to_string(list_sort(list_distinct(list_filter(list_transform({found}, lambda x: {S.squeeze('x')}), lambda x: x <> '' AND length(x) < 100))), ',')"


@query(
    "wikitext_clean_categories",
    f"""WITH w AS (SELECT doc_id, {TITLE} AS title, {NAMESPACE} AS ns, {BODY} AS body FROM documents)
    SELECT doc_id, {_plain_sql('body')} AS cleaned, {_categories_sql('body', '|')} AS cats, {_categories_sql('body', '|' + chr(92) + ']')} AS strict_cats,
      coalesce(ns, 0) = 0 AND body <> '' AND NOT starts_with(upper(substr(body, 1, 9)), '#REDIRECT') AS article, 'https://tt.wikipedia.org/wiki/' || replace(title, ' ', '_') AS url FROM w""",
)
def wikitext_clean_categories(spark, sf_dir):
    w = made(spark, sf_dir, "documents", ["doc_id"], title=TITLE, ns=NAMESPACE, body=BODY)
    return w.select("doc_id", wikitext.plain("body").alias("cleaned"), F.array_join(wikitext.categories("body"), ",").alias("cats"), F.array_join(wikitext.categories("body", strict=True), ",").alias("strict_cats"), wikitext.is_article("title", "body", "ns").alias("article"), wikitext.page_url(F.lit("ttwiki"), "title").alias("url"))


COMMENT = case("(conv_id + turn)", "text", f"role || {NL} || '2 days ago' || {NL} || text", f"{NL} || role || {NL} || text", f"' ' || role || ' ' || {NL} || text")
WRITER = case("conv_id", "role", "''", "NULL")


@query(
    "rutube_unify",
    f"""WITH c AS (SELECT conv_id, turn, {COMMENT} AS content, nullif({WRITER}, '') AS author FROM conversations), l AS (SELECT *, list_filter(list_transform(string_split(content, {NL}), lambda x: {S.strip('x')}), lambda x: x <> '') AS lines FROM c)
    SELECT conv_id, turn, coalesce(author, nullif({S.strip(f'split_part(content, {NL}, 1)')}, '')) AS author, CASE WHEN author IS NULL AND len(lines) >= 3 THEN array_to_string(lines[3:], {NL}) ELSE content END AS body FROM l""",
)
def rutube_unify(spark, sf_dir):
    r = made(spark, sf_dir, "conversations", ["conv_id", "turn"], content=COMMENT, author=WRITER).withColumn("u", unify.rutube_fields("content", "author"))
    return r.select("conv_id", "turn", F.col("u.author").alias("author"), F.col("u.content").alias("body"))


STEM = case("doc_id", f"{W1} || '_' || {W2}", f"{W1} || ' - ' || {W2} || '-' || {W3}", f"{W1} || '-' || {W2}", W1, f"{W1} || '_' || {W2} || '_' || {W3}")
RELATIVE = f"CASE WHEN doc_id % 3 = 0 THEN {STEM} ELSE source || '/' || lang || '/' || {STEM} END || '.txt'"


def _parted(part: str) -> str:
    side = {"author": "trim(substr(stem, 1, strpos(stem, '{0}') - 1))", "title": "trim(substr(stem, strpos(stem, '{0}') + length('{0}')))"}[part]
    return "CASE " + " ".join(f"WHEN contains(stem, '{s}') THEN {side.format(s)}" for s in ("_", " - ", "-")) + (" ELSE stem END" if part == "title" else " END")


@query("filename_meta", f"WITH f AS (SELECT doc_id, {STEM} AS stem, {RELATIVE} AS rel FROM documents) SELECT doc_id, {_parted('author')} AS author, {_parted('title')} AS title, CASE WHEN contains(rel, '/') THEN split_part(rel, '/', 1) END AS rubric FROM f")
def filename_meta(spark, sf_dir):
    f = made(spark, sf_dir, "documents", ["doc_id"], stem=STEM, rel=RELATIVE).withColumn("m", unify.file_fields("stem"))
    return f.select("doc_id", "m.author", "m.title", unify.rubric("rel").alias("rubric"))


ANSWER = """CASE WHEN doc_id % 5 = 0 THEN '{"data":[]}' ELSE '{"data":[{"id":' || doc_id || ',"title":"' || source || '","publish_date":' || CASE WHEN doc_id % 2 = 0 THEN 'null' ELSE '"2024-01-02"' END
  || ',"news_date":"2023-12-31","text":"<p>' || lang || '</p>","news_type_relation":[{"news_type":{"name":"' || lang || '"}},{"news_type":{"name":"' || source || '"}}]},{"id":' || (doc_id + 1000000)
  || ',"title":"second","publish_date":"","news_date":"2022-01-02","text":"y","news_type_relation":[]}]}' END"""
ITEM = "array<struct<id:bigint,title:string,publish_date:string,news_date:string,text:string,news_type_relation:array<struct<news_type:struct<name:string>>>>>"


@query(
    "api_project",
    """SELECT doc_id AS page, doc_id AS id, source AS title, CASE WHEN doc_id % 2 = 0 THEN '2023-12-31' ELSE '2024-01-02' END AS date, '<p>' || lang || '</p>' AS content, lang || ', ' || source AS category, 'https://a.tj/event/news/' || doc_id AS url FROM documents WHERE doc_id % 5 <> 0
    UNION ALL SELECT doc_id, doc_id + 1000000, 'second', '2022-01-02', 'y', '', 'https://a.tj/event/news/' || (doc_id + 1000000) FROM documents WHERE doc_id % 5 <> 0""",
)
def api_project(spark, sf_dir):
    """Items at a path of a JSON body, fields by dotted paths, the first filled of several dates, an address template."""
    items = made(spark, sf_dir, "documents", [F.col("doc_id").alias("page")], body=ANSWER).select("page", F.explode(F.from_json(F.get_json_object("body", "$.data"), ITEM)).alias("i"))
    return items.select("page", "i.id", "i.title", X.first_filled("i.publish_date", "i.news_date").alias("date"), F.col("i.text").alias("content"), F.array_join(F.transform("i.news_type_relation", lambda r: r["news_type"]["name"]), ", ").alias("category"), F.concat(F.lit("https://a.tj/event/news/"), F.col("i.id").cast("string")).alias("url"))


@query("api_last_page", "SELECT max(doc_id) AS last_page FROM documents WHERE doc_id % 5 <> 0")
def api_last_page(spark, sf_dir):
    n = F.size(F.from_json(F.get_json_object("body", "$.data"), ITEM))
    return made(spark, sf_dir, "documents", [F.col("doc_id").alias("page")], body=ANSWER).where(n > 0).agg(F.max("page").alias("last_page"))


BARE = "split_part(url, '?', 1)"
CURRENT = f"{BARE} || " + case("page_id", "'/page/' || (page_id % 6 + 1)", "'?page=' || (page_id % 4 + 1)", "'?p=' || (page_id % 4)", "''", "'?x=1&page=' || (page_id % 3) || '#a'")
CANDIDATE = f"{BARE} || " + case("page_id", "'?page=' || (page_id % 3 + 1)", "'/page/' || (page_id % 4)", "'/x'", "'?p=' || (page_id % 3)", "'/page/1'", "'?q=a&p=2'", "'/page/3?page=2'")


def _numbers_sql(c: str) -> str:
    by_key = [f"TRY_CAST(nullif(regexp_extract({c}, '[?&]{k}=([0-9]+)(?:&|#|$)', 1), '') AS BIGINT)" for k in ("page", "p")]
    return f"{by_key[0]} AS {c}_page, {by_key[1]} AS {c}_p, TRY_CAST(nullif(regexp_extract({S.path(c)}, '/page/([0-9]+)', 1), '') AS BIGINT) AS {c}_path"


@query(
    "forward_pagination",
    f"""WITH v AS (SELECT page_id, {CURRENT} AS cur, {CANDIDATE} AS cand FROM pages), n AS (SELECT page_id, cur, cand, {_numbers_sql('cur')}, {_numbers_sql('cand')} FROM v)
    SELECT page_id, cur, cand, CASE WHEN cur_page IS NOT NULL AND cand_page IS NOT NULL THEN cand_page > cur_page WHEN cur_p IS NOT NULL AND cand_p IS NOT NULL THEN cand_p > cur_p
      WHEN cur_path IS NOT NULL THEN cand_path IS NOT NULL AND cand_path > cur_path WHEN cand_path IS NOT NULL THEN cand_path > 1 ELSE true END AS forward FROM n""",
)
def forward_pagination(spark, sf_dir):
    return made(spark, sf_dir, "pages", ["page_id"], cur=CURRENT, cand=CANDIDATE).select("page_id", "cur", "cand", urls.is_forward("cur", "cand").alias("forward"))


BASE = "CASE WHEN page_id % 3 = 0 THEN split_part(url, '/', 1) || '//' || split_part(url, '/', 3) || '/' || (2000 + page_id % 25) || '/0' || (page_id % 9 + 1) || '/n/' ELSE url END"
HREF = case("page_id", "'/n/' || page_id", "'mailto:q'", "'https://b.tj/q#r'", "'x/y'", "'../z#f'", "'?page=2'", "''", "'#top'", "NULL", "'  /n/ '")
ROOT = "regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
FOLDER = f"regexp_replace({S.path('base')}, '[^/]*$', '')"


@query(
    "relative_links",
    f"""WITH v AS (SELECT page_id, {BASE} AS base, {HREF} AS href FROM pages)
    SELECT page_id, base, href, CASE WHEN href IS NULL OR trim(href) = '' OR starts_with(href, 'mailto:') OR starts_with(href, '#') THEN NULL WHEN starts_with(trim(href), '/') THEN {ROOT} || trim(href) WHEN starts_with(href, 'https:') THEN split_part(href, '#', 1)
      WHEN starts_with(href, '../') THEN {ROOT} || regexp_replace({FOLDER}, '[^/]+/$', '') || split_part(substr(href, 4), '#', 1) WHEN starts_with(href, '?') THEN {ROOT} || {S.path('base')} || href ELSE {ROOT} || {FOLDER} || href END AS url,
      CASE WHEN regexp_matches(base, '/[0-9]{{4}}/[0-9]{{2}}/') THEN regexp_extract(base, '/([0-9]{{4}})/[0-9]{{2}}/', 1) || '-' || regexp_extract(base, '/[0-9]{{4}}/([0-9]{{2}})/', 1) END AS ym,
      CASE WHEN len(string_split({S.path('base')}, '/')) > 2 AND split_part({S.path('base')}, '/', 2) NOT IN ('', 'page', 'node') THEN split_part({S.path('base')}, '/', 2) END AS section FROM v""",
)
def relative_links(spark, sf_dir):
    v = made(spark, sf_dir, "pages", ["page_id"], base=BASE, href=HREF)
    return v.select("page_id", "base", "href", urls.absolute("base", "href").alias("url"), urls.year_month("base").alias("ym"), urls.section("base").alias("section"))


@query("ordered_distinct", "WITH l AS (SELECT conv_id, turn, string_split(text, ' ') AS l FROM conversations) SELECT conv_id, turn, array_to_string(list_filter(l, lambda x, i: x <> '' AND list_position(l, x) = i), ' ') AS items FROM l")
def ordered_distinct(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(X.distinct_kept(F.split("text", " ")), " ").alias("items"))


NARROW, WIDE = "abcdefghijklmnopqrstuvwxyz0123456789", "ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ０１２３４５６７８９"


@query("nfkc_normal_form", f"SELECT doc_id, {S.normal_form('text')} AS form FROM documents")
def nfkc_normal_form(spark, sf_dir):
    """The normal form of texts whose letters are wide or in ligatures: that of the plain texts."""
    wide = F.translate(F.replace("text", F.lit("fi"), F.lit("ﬁ")), NARROW, WIDE)
    return table(spark, sf_dir, "documents").select("doc_id", X.normal_form(wide).alias("form"))


SIGNED = case(
    "page_id", "replace(html, '</article>', '<span class=\"byline\">Ali Vali ' || page_id || '</span></article>')", "replace(html, '</article>', '<p>Автор: Иван Петров ' || page_id || '</p></article>')", "replace(html, '</article>', '<p>Редакция: сайт</p></article>')", "html",
    "replace(html, '</article>', '<p>Язган Гали Вали. Казан</p><div class=\"x_author_y\">Name ' || page_id || '</div></article>')",
)


@query(
    "html_bylines",
    f"""SELECT page_id, {case('page_id', "'Ali Vali ' || page_id", "'Автор: Иван Петров ' || page_id", "'Редакция:'", 'NULL', "'Name ' || page_id")} AS byline,
      {case('page_id', "'css:.byline'", "'regex:0'", "'regex:11'", 'NULL', S.lit('css:' + H.BYLINE_SELECTORS[7]))} AS place FROM pages WHERE contains(html, '</article>')""",
)
def html_bylines(spark, sf_dir):
    """Bylines put into pages as an element or as text."""
    p = made(spark, sf_dir, "pages", ["page_id"], html=SIGNED, whole="contains(html, '</article>')").where("whole")
    return p.select("page_id", H.bylines("html").alias("b")).select("page_id", F.col("b.text").alias("byline"), F.col("b.source").alias("place"))


LETTERED = "text || ' ' || " + case("doc_id", "'ә'", "'ғқ'", "'æ'", "'ӟ'", "'ғц'", "'Ә'", "''")
SPOKEN = "split_part('tg,os,udm,ba,tt,en', ',', CAST(doc_id % 6 + 1 AS INT))"


def _rules_sql() -> str:
    rules = [f"WHEN '{k}' THEN regexp_matches(text, '[{yes}]')" + (f" AND NOT regexp_matches(text, '[{no}]')" if no else "") for k, (yes, no) in scripts.LETTER_RULES.items()]
    return f"CASE language {' '.join(rules)} ELSE true END"


@query("letter_rules_five", f"SELECT doc_id, language FROM (SELECT doc_id, {LETTERED} AS text, {SPOKEN} AS language FROM documents) WHERE {_rules_sql()}")
def letter_rules_five(spark, sf_dir):
    """The letter rules of the five languages that have them; a sixth takes all."""
    v = made(spark, sf_dir, "documents", ["doc_id"], text=LETTERED, language=SPOKEN)
    return v.where(scripts.fits_language("text", "language")).select("doc_id", "language")
