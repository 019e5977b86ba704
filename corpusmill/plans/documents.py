"""Queries over documents and labels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import html as H, predicates, scripts, text as X, wikitext
from ..operators import dedup, metrics, unify
from . import sql as S
from .registry import query, table

SEED_PAGES = "regexp_extract(html, '<h1>([^<]*)</h1>', 1)"


def corpus_rows(spark, sf_dir, whole=False):
    """Unified rows of pages (news), conversations (social), benchmark texts (as wiki articles) and documents, each with seq.

    whole: title and content of pages from the HTML tree; else what SQL can express, the first plain paragraph.
    """
    found = F.struct(F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("title"), F.regexp_extract("html", "<p>([^<]*)</p>", 1).alias("content"))
    pages = table(spark, sf_dir, "pages").withColumn("f", H.page_text("html") if whole else found).select(F.col("page_id").alias("seq"), "url", "f.title", "f.content", F.nullif(F.regexp_extract("html", '<html[^>]*lang="([^"]+)"', 1), F.lit("")).alias("language"))
    talks = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 100_000 + F.col("turn")).alias("seq"), unify.wall_url(F.lit(None), "conv_id").alias("url"), F.substring("text", 1, 120).alias("title"), F.col("text").alias("content"), F.col("role").alias("author"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), "text", F.col("source").alias("category"), F.col("lang").alias("language"))
    name = F.concat(F.lit("Item "), F.col("item_id").cast("string"))
    articles = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("seq"), name.alias("title"), wikitext.page_url(F.lit("ttwiki"), name).alias("url"), "text", F.array(F.concat(F.lit("Part "), (F.col("item_id") % 3).cast("string")), F.lit("All")).alias("categories"))
    return unify.corpus({"news": unify.unify(pages, "news"), "social": unify.unify(talks, "social_vk_post"), "wiki": unify.wiki(articles, F.lit("tt")), "document": unify.unify(docs, "document")})


UNIFIED = f"""WITH rows AS (
      SELECT page_id AS seq, 0 AS source_rank, nullif(url, '') AS url, {S.strip("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS title, {S.strip("regexp_extract(html, '<p>([^<]*)</p>', 1)")} AS content,
        CAST(NULL AS VARCHAR) AS author, CAST(NULL AS VARCHAR) AS date, CAST(NULL AS VARCHAR) AS category, 'news' AS source_type, nullif(regexp_extract(html, '<html[^>]*lang="([^"]+)"', 1), '') AS language FROM pages
      UNION ALL SELECT conv_id * 100000 + turn, 1, 'https://vk.com/wall0_' || conv_id, {S.strip("substr(text, 1, 120)")}, {S.strip("text")}, nullif(role, ''), NULL, NULL, 'social_vk_post', NULL FROM conversations
      UNION ALL SELECT item_id, 2, 'https://tt.wikipedia.org/wiki/Item_' || item_id, 'Item ' || item_id, {S.strip("coalesce(text, '')")}, NULL, NULL, 'Part ' || item_id % 3, 'wiki', 'tt' FROM benchmark
      UNION ALL SELECT doc_id, 3, NULL, '', {S.strip("coalesce(text, '')")}, NULL, NULL, source, 'document', nullif(lang, '') FROM documents)
    SELECT url, title, content, author, date, category, source_type, language FROM rows WHERE coalesce(url, nullif(content, '')) IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY coalesce(url, content) ORDER BY source_rank, seq) = 1"""


@query("corpus_unify_dedup", UNIFIED)
def corpus_unify_dedup(spark, sf_dir):
    return dedup.first_wins(corpus_rows(spark, sf_dir), dedup.corpus_key(), ["source_rank", "seq"]).select(*unify.CORPUS)


@query("corpus_unify_repeated", UNIFIED)
def corpus_unify_repeated(spark, sf_dir):
    """corpus_unify_dedup where each row comes twice, alike in everything: as from a file that was collected twice."""
    rows = corpus_rows(spark, sf_dir)
    return dedup.first_wins(rows.withColumn("twice", F.explode(F.array(F.lit(1), F.lit(1)))).drop("twice"), dedup.corpus_key(), ["source_rank", "seq"]).select(*unify.CORPUS)


@query(
    "first_of_equal_order",
    """SELECT k, doc_id, text FROM (SELECT lang AS k, doc_id, text FROM documents UNION ALL SELECT lang, doc_id, text || '!' FROM documents) WHERE k IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, text) = 1""",
)
def first_of_equal_order(spark, sf_dir):
    """Of rows that two inputs hold under the same key and order, one of each key, the lesser by what else it holds."""
    rows = table(spark, sf_dir, "documents").select(F.col("lang").alias("k"), "doc_id", "text")
    return dedup.first_wins(rows.unionByName(rows.withColumn("text", F.concat("text", F.lit("!")))), F.col("k"), ["doc_id"])


@query("corpus_unify_whole")
def corpus_unify_whole(spark, sf_dir):
    """corpus_unify_dedup with the whole content of pages."""
    return dedup.first_wins(corpus_rows(spark, sf_dir, whole=True), dedup.corpus_key(), ["source_rank", "seq"]).select(*unify.CORPUS)


@query(
    "corpus_by_source_language",
    f"""WITH c AS (SELECT 'news' AS source_type, nullif(regexp_extract(html, '<html[^>]*lang="([^"]+)"', 1), '') AS language FROM pages
      UNION ALL SELECT 'social_vk_post', NULL FROM conversations UNION ALL SELECT 'document', nullif(lang, '') FROM documents)
    SELECT source_type, language, count(*) AS n FROM c WHERE source_type IN ('news', 'document') GROUP BY ALL""",
)
def corpus_by_source_language(spark, sf_dir):
    return corpus_rows(spark, sf_dir).where(F.col("source_type").isin("news", "document")).groupBy("source_type", "language").agg(F.count("*").alias("n"))


@query("clean_text_hash", f"SELECT doc_id, {S.squeeze('text')} AS clean, substr(sha256(coalesce(text, '')), 1, 32) AS sha, md5(text) AS md5, substr(sha256(coalesce(text, '') || '|' || coalesce(source, '') || '|' || doc_id), 1, 32) AS record, {S.excerpt('text')} AS excerpt FROM documents")
def clean_text_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.squeeze("text").alias("clean"), X.sha("text").alias("sha"), F.md5("text").alias("md5"), X.record_hash("text", "source", "doc_id").alias("record"), X.excerpt("text").alias("excerpt"))


@query("doc_clean_boilerplate", f"SELECT doc_id, clean FROM (SELECT doc_id, {S.without_boilerplate('text')} AS clean FROM documents) WHERE length(clean) >= 100")
def doc_clean_boilerplate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.without_boilerplate("text").alias("clean")).where(F.length("clean") >= 100)


@query("snippet_and_fallback", f"SELECT doc_id, {S.strip('replace(substr(text, 1, 500), chr(10), chr(32))')} AS snippet, coalesce(nullif(lang, ''), nullif(source, ''), '?') AS label, CASE WHEN length(text) >= 500 THEN 'high' ELSE 'medium' END AS confidence FROM documents")
def snippet_and_fallback(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.strip(X.snippet("text")).alias("snippet"), X.first_filled("lang", "source", F.lit("?")).alias("label"), X.confidence("text").alias("confidence"))


EXACT = f"SELECT source, lang, md5({S.normal_form('text')}) AS h FROM documents WHERE length(trim(text)) >= 50"


@query("exact_dup_rate_by_source", f"SELECT source, count(*) AS total, count(*) - count(DISTINCT h) AS exact_dups, round(100.0 * (count(*) - count(DISTINCT h)) / count(*), 2) AS exact_dup_pct FROM ({EXACT}) GROUP BY source")
def exact_dup_rate_by_source(spark, sf_dir):
    return dedup.exact_duplicates(table(spark, sf_dir, "documents"), ["source"])


@query(
    "quality_summary_by_lang",
    f"""WITH e AS ({EXACT}), d AS (SELECT source, lang, count(*) AS total, count(*) - count(DISTINCT h) AS dups FROM e GROUP BY ALL)
    SELECT lang, count(*) AS datasets, CAST(sum(total) AS BIGINT) AS total, CAST(sum(dups) AS BIGINT) AS exact_dups, round(100.0 * sum(dups) / sum(total), 2) AS exact_dup_pct FROM d GROUP BY lang""",
)
def quality_summary_by_lang(spark, sf_dir):
    each = dedup.exact_duplicates(table(spark, sf_dir, "documents"), ["source", "lang"])
    out = each.groupBy("lang").agg(F.count("*").alias("datasets"), F.sum("total").alias("total"), F.sum("exact_dups").alias("exact_dups"))
    return out.withColumn("exact_dup_pct", F.round(100.0 * F.col("exact_dups") / F.col("total"), 2))


@query(
    "lang_purity_top_other",
    """WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL)
    SELECT source, CAST(sum(n) AS BIGINT) AS total, CAST(coalesce(sum(n) FILTER (lang = 'en'), 0) AS BIGINT) AS lang_correct, round(100.0 * coalesce(sum(n) FILTER (lang = 'en'), 0) / sum(n), 2) AS purity_pct,
      substr(coalesce(string_agg(lang || '=' || n, '; ' ORDER BY n DESC, lang) FILTER (lang <> 'en'), ''), 1, 200) AS top_other_langs FROM c GROUP BY source""",
)
def lang_purity_top_other(spark, sf_dir):
    return metrics.purity(table(spark, sf_dir, "documents"), ["source"], "lang", F.lit("en"))


@query(
    "first_n_sample_quality",
    f"""WITH s AS (SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 20), e AS (SELECT source, md5({S.normal_form('text')}) AS h FROM s WHERE length(trim(text)) >= 50)
    SELECT source, count(*) AS total, count(*) - count(DISTINCT h) AS exact_dups, round(100.0 * (count(*) - count(DISTINCT h)) / count(*), 2) AS exact_dup_pct FROM e GROUP BY source""",
)
def first_n_sample_quality(spark, sf_dir):
    w = Window.partitionBy("source").orderBy("doc_id")
    first = table(spark, sf_dir, "documents").withColumn("r", F.row_number().over(w)).where(F.col("r") <= 20)
    return dedup.exact_duplicates(first, ["source"])


@query(
    "doc_quality_metrics",
    f"""WITH w AS (SELECT doc_id, text, {S.words('lower(text)')} AS w FROM documents)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS words_count, round(len(list_distinct(w)) / greatest(len(w), 1), 3) AS unique_words_ratio, round(length(text) / 1, 1) AS chars_per_page,
      length(text) >= 80 AND (length(regexp_replace(text, {S.lit(X.WS.replace('[', '[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}', 1))}, '', 'g')) / length(text) < 0.5 OR (len(w) >= 200 AND len(list_distinct(w)) / len(w) < 0.05)) AS has_garbage FROM w""",
)
def doc_quality_metrics(spark, sf_dir):
    low = X.words(F.lower("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(low).cast("long").alias("words_count"), X.unique_word_ratio("text").alias("unique_words_ratio"), F.round(F.length("text") / F.lit(1), 1).alias("chars_per_page"), predicates.is_garbage("text").alias("has_garbage"))


def _alphabet_sql() -> str:
    cyr = f"length(regexp_replace(lower(text), '[^{scripts.CYRILLIC}]', '', 'g'))"
    lat = "length(regexp_replace(lower(text), '[^a-z]', '', 'g'))"
    return f"""WITH n AS (SELECT doc_id, text, {cyr} AS c, {lat} AS l FROM documents), r AS (SELECT *, CASE WHEN c + l = 0 THEN 0.0 ELSE c / (c + l) END AS a, CASE WHEN c + l = 0 THEN 0.0 ELSE l / (c + l) END AS b FROM n)
      SELECT doc_id, CASE WHEN text = '' THEN 'empty' WHEN c + l = 0 THEN 'other' WHEN a > 0.8 THEN 'cyrillic' WHEN b > 0.8 THEN 'latin' WHEN a > 0.4 AND b > 0.4 THEN 'mixed' WHEN a > 0.3 THEN 'cyrillic' WHEN b > 0.3 THEN 'latin' ELSE 'other' END AS alphabet,
      round(CAST(a AS DOUBLE), 6) AS cyr_ratio, round(CAST(b AS DOUBLE), 6) AS lat_ratio FROM r"""


@query("script_ratio_alphabet", _alphabet_sql())
def script_ratio_alphabet(spark, sf_dir):
    a = table(spark, sf_dir, "documents").select("doc_id", scripts.alphabet("text").alias("a"))
    return a.select("doc_id", "a.alphabet", F.round("a.cyr_ratio", 6).alias("cyr_ratio"), F.round("a.lat_ratio", 6).alias("lat_ratio"))


@query("alphabet_counts", f"SELECT alphabet, count(*) AS n, round(avg(lat_ratio), 4) AS lat_mean FROM ({_alphabet_sql()}) GROUP BY alphabet")
def alphabet_counts(spark, sf_dir):
    return script_ratio_alphabet(spark, sf_dir).groupBy("alphabet").agg(F.count("*").alias("n"), F.round(F.avg("lat_ratio"), 4).alias("lat_mean"))


@query(
    "script_fallback_lang",
    f"""SELECT doc_id, CASE WHEN length(regexp_replace(lower(text), '[^{scripts.CYRILLIC_PLAIN}]', '', 'g')) > length(regexp_replace(lower(text), '[^a-z]', '', 'g')) THEN 'cyrillic'
      WHEN length(regexp_replace(lower(text), '[^a-z]', '', 'g')) > 0 THEN 'latin' ELSE 'unknown' END AS script FROM documents""",
)
def script_fallback_lang(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", scripts.script("text").alias("script"))


RULES = scripts.LETTER_RULES | {"de": ("äöüß", "ñ"), "fr": ("éèêç", "ß"), "es": ("ñóíá", "ß")}


@query("letter_rule_filter", "SELECT doc_id, lang FROM documents WHERE CASE lang WHEN 'de' THEN NOT regexp_matches(text, '[ñ]') AND regexp_matches(text, '[äöüß]') WHEN 'fr' THEN NOT regexp_matches(text, '[ß]') AND regexp_matches(text, '[éèêç]') WHEN 'es' THEN NOT regexp_matches(text, '[ß]') AND regexp_matches(text, '[ñóíá]') ELSE true END")
def letter_rule_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(scripts.fits_language("text", "lang", RULES)).select("doc_id", "lang")


@query("transliterate_latin", f"SELECT doc_id, {S.to_cyrillic('text')} AS cyrillic FROM documents")
def transliterate_latin(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", scripts.to_cyrillic("text").alias("cyrillic"))


NOISE = ("more", "read also", "share", "der ")


@query("noise_text_filter", f"SELECT doc_id FROM documents WHERE length({S.squeeze('text')}) < 3 OR regexp_matches(lower({S.squeeze('text')}), 'more|read also|share|der ')")
def noise_text_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(predicates.is_noise_text("text", NOISE)).select("doc_id")


@query("length_gates", "SELECT doc_id, length(text) >= 100 AS wiki, length(text) >= 10 AS post, length(trim(text)) >= 50 AS quality, length(text) >= 300 AS gold FROM documents")
def length_gates(spark, sf_dir):
    n = F.length("text")
    return table(spark, sf_dir, "documents").select("doc_id", (n >= 100).alias("wiki"), (n >= 10).alias("post"), (F.length(F.trim("text")) >= 50).alias("quality"), (n >= 300).alias("gold"))


COUNTS = f"SELECT source, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(len({S.tokens('text')})) AS BIGINT) AS tokens FROM documents GROUP BY source"


@query("docs_chars_tokens_by_source", f"SELECT *, round(tokens / docs, 1) AS tokens_per_doc FROM ({COUNTS})")
def docs_chars_tokens_by_source(spark, sf_dir):
    return metrics.counts(table(spark, sf_dir, "documents"), ["source"])


@query("group_totals_rollup", f"SELECT coalesce(source, 'TOTAL') AS source, CAST(sum(docs) AS BIGINT) AS docs, CAST(sum(chars) AS BIGINT) AS chars, CAST(sum(tokens) AS BIGINT) AS tokens FROM ({COUNTS}) GROUP BY ROLLUP (source)")
def group_totals_rollup(spark, sf_dir):
    return metrics.with_total(metrics.counts(table(spark, sf_dir, "documents"), ["source"]), "source", ["docs", "chars", "tokens"])


#: A public tokenizer's file; where it lies is a parameter of the operator.
TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"


@query("tokenizer_counts")
def tokenizer_counts(spark, sf_dir):
    """Documents, characters and a tokenizer's tokens by source."""
    return metrics.tokenizer_counts(table(spark, sf_dir, "documents"), ["source"], TOKENIZER)


@query("token_column_merge", f"SELECT source, docs, CASE WHEN source < 'src5' THEN docs * 7 ELSE tokens END AS tokens FROM ({COUNTS})")
def token_column_merge(spark, sf_dir):
    """Earlier results keep their filled column; the others are computed."""
    now = metrics.counts(table(spark, sf_dir, "documents"), ["source"])
    earlier = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")).select("source", F.when(F.col("source") < "src5", F.col("n") * 7).otherwise(0).alias("old"))
    return now.join(earlier, "source", "left").select("source", "docs", F.coalesce(F.nullif("old", F.lit(0)), "tokens").alias("tokens"))


@query("resume_antijoin", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def resume_antijoin(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id", "source")


@query("label_distribution", "SELECT quality, toxic, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM labels GROUP BY quality, toxic")
def label_distribution(spark, sf_dir):
    n = table(spark, sf_dir, "labels").groupBy("quality", "toxic").agg(F.count("*").alias("n"))
    return n.select("quality", "toxic", "n", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2).alias("pct"))  # one row for each pair of labels


@query(
    "label_topn_category",
    """WITH c AS (SELECT quality, source AS category, count(*) AS n FROM labels JOIN documents USING (doc_id) WHERE trim(source) <> '' GROUP BY ALL)
    SELECT quality, category, n, round(100.0 * n / sum(n) OVER (PARTITION BY quality), 2) AS pct FROM c QUALIFY row_number() OVER (PARTITION BY quality ORDER BY n DESC, category) <= 5""",
)
def label_topn_category(spark, sf_dir):
    c = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("category")), "doc_id").where(F.trim("category") != "").groupBy("quality", "category").agg(F.count("*").alias("n"))
    by = Window.partitionBy("quality")
    return c.withColumns({"pct": F.round(100.0 * F.col("n") / F.sum("n").over(by), 2), "r": F.row_number().over(by.orderBy(F.desc("n"), "category"))}).where(F.col("r") <= 5).drop("r")


@query("top_words", f"SELECT w, count(*) AS n FROM (SELECT unnest({S.tokens('text')}) AS w FROM documents) GROUP BY w ORDER BY n DESC, w LIMIT 20")
def top_words(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.explode(X.tokens("text")).alias("w")).groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(20)


@query("body_length_stats", "SELECT lang, count(length(text)) AS n, round(avg(length(text)), 4) AS mean, CAST(median(length(text)) AS DOUBLE) AS median, CAST(min(length(text)) AS BIGINT) AS min, CAST(max(length(text)) AS BIGINT) AS max FROM documents GROUP BY lang")
def body_length_stats(spark, sf_dir):
    from ..sources.files import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return metrics.summary(table(spark, sf_dir, "documents").select("lang", F.length("text").cast("long").alias("n_c")), ["lang"], "n_c")


def pairs(spark, sf_dir):
    """Each document with one benchmark text, by turns."""
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id"), F.col("text").alias("gold"))
    n = items.count()
    return table(spark, sf_dir, "documents").select("doc_id", "text", F.pmod("doc_id", F.lit(n)).alias("item_id")).join(items, "item_id")


PAIRS = "(SELECT d.doc_id, d.text, b.text AS gold FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark))"


@query(
    "word_prf1",
    f"""WITH t AS (SELECT doc_id, list_distinct({S.tokens('text')}) AS x, list_distinct({S.tokens('gold')}) AS y FROM {PAIRS}), r AS (SELECT doc_id, coalesce(len(list_intersect(x, y)) / nullif(len(x), 0), 0.0) AS p, coalesce(len(list_intersect(x, y)) / nullif(len(y), 0), 0.0) AS r FROM t)
    SELECT doc_id, round(p, 4) AS precision, round(r, 4) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 4) AS f1 FROM r""",
)
def word_prf1(spark, sf_dir):
    return pairs(spark, sf_dir).select("doc_id", metrics.word_overlap("text", "gold").alias("o")).select("doc_id", "o.*")


@query(
    "rouge1_f1",
    f"""WITH t AS (SELECT doc_id, {S.tokens('text')} AS x, {S.tokens('gold')} AS y FROM {PAIRS}),
    o AS (SELECT doc_id, len(x) AS x, len(y) AS y, coalesce(list_sum(list_transform(list_intersect(x, y), lambda w: least(len(list_filter(x, lambda v: v = w)), len(list_filter(y, lambda v: v = w))))), 0) AS o FROM t),
    r AS (SELECT doc_id, coalesce(o / nullif(x, 0), 0.0) AS a, coalesce(o / nullif(y, 0), 0.0) AS b FROM o)
    SELECT doc_id, round(CASE WHEN a + b > 0 THEN 2 * a * b / (a + b) ELSE 0.0 END, 4) AS rouge_1 FROM r""",
)
def rouge1_f1(spark, sf_dir):
    words = pairs(spark, sf_dir).select("doc_id", X.tokens("text").alias("x"), X.tokens("gold").alias("y"))
    return words.select("doc_id", metrics.rouge_1("x", "y").alias("rouge_1"))


@query("rouge_l_f1")
def rouge_l_f1(spark, sf_dir):
    return pairs(spark, sf_dir).select("doc_id", metrics.rouge_l("text", "gold").alias("rouge_l"))


@query("near_dup_rate")
def near_dup_rate(spark, sf_dir):
    """By source: near_dup_base (distinct normal forms of 500 characters or more), near_dups, near_dup_pct."""
    from ..sources.files import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents").where(F.length(F.trim("text")) >= 50)
    base = dedup.first_wins(docs, F.concat_ws("|", "source", X.normal_form("text")), ["doc_id"])
    banded = dedup.minhash_bands(base.select("doc_id", "source", "text"), "text")
    by_source = banded.select("doc_id", "source", F.transform("band", lambda b: F.xxhash64(b, "source")).alias("band")).checkpoint()
    found = dedup.greedy_near_duplicates(by_source, "doc_id").join(by_source.select(F.col("doc_id").alias("id"), "source"), "id")
    out = found.groupBy("source").agg(F.count("*").alias("near_dup_base"), F.count_if(~F.col("retained")).alias("near_dups"))
    return out.withColumn("near_dup_pct", F.round(100.0 * F.col("near_dups") / F.col("near_dup_base"), 2))


@query(
    "shingle_jaccard",
    f"""WITH s AS (SELECT item_id, list_distinct(list_transform(range(1, CAST(length(t) - 3 AS BIGINT)), lambda i: substr(t, i, 5))) AS s FROM (SELECT item_id, {S.normal_form('text')} AS t FROM benchmark))
    SELECT a.item_id AS a, b.item_id AS b, round(len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))), 4) AS jaccard FROM s a JOIN s b ON b.item_id = a.item_id + 1""",
)
def shingle_jaccard(spark, sf_dir):
    """Exact similarity of each benchmark text and the next."""
    t = table(spark, sf_dir, "benchmark").select("item_id", X.normal_form("text", unicode_form=False).alias("t"))
    s = t.select("item_id", F.expr("if(length(t) < 5, cast(array() as array<string>), array_distinct(transform(sequence(1, greatest(length(t) - 4, 1)), i -> substring(t, i, 5))))").alias("s"))
    a, b = s.select(F.col("item_id").alias("a"), F.col("s").alias("x")), s.select(F.col("item_id").alias("b"), F.col("s").alias("y"))
    both = a.join(b, F.col("b") == F.col("a") + 1)
    return both.select("a", "b", F.round(F.size(F.array_intersect("x", "y")) / F.size(F.array_union("x", "y")), 4).alias("jaccard"))


@query("sample_by_source", "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3")
def sample_by_source(spark, sf_dir):
    """At most three rows of each source, the first by id."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source")
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))).where(F.col("r") <= 3).drop("r")


@query("split_choice", "SELECT source, min(lang) AS split FROM documents WHERE NOT starts_with(lang, 'es') GROUP BY source")
def split_choice(spark, sf_dir):
    """The preferred split of each dataset: ranked names, those with a skipped prefix left out."""
    rank = F.when(F.col("lang") == "full", 0).when(F.col("lang") == "train", 1).otherwise(2)
    kept = table(spark, sf_dir, "documents").where(~F.col("lang").startswith("es"))
    return kept.groupBy("source").agg(F.min_by("lang", F.struct(rank, "lang")).alias("split"))


@query(
    "word_set_algebra",
    f"""WITH w AS (SELECT DISTINCT lang, w FROM (SELECT lang, unnest({S.tokens('text')}) AS w FROM documents)), n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
    s AS (SELECT x.lang AS a, y.lang AS b, count(*) AS shared FROM w x JOIN w y USING (w) WHERE x.lang < y.lang GROUP BY ALL)
    SELECT x.lang AS a, y.lang AS b, coalesce(shared, 0) AS shared, x.n + y.n - coalesce(shared, 0) AS either FROM n x JOIN n y ON x.lang < y.lang LEFT JOIN s ON s.a = x.lang AND s.b = y.lang""",
)
def word_set_algebra(spark, sf_dir):
    """How many words of whole texts two languages share, and how many either has."""
    return _word_sets(table(spark, sf_dir, "documents").select("lang", F.explode(X.tokens("text")).alias("w")).distinct())


def _word_sets(w):
    """By pair of languages: words (lang, w; distinct) that both have, and that either has."""
    sizes = w.groupBy("lang").agg(F.count("*").alias("n"))
    shared = w.select(F.col("lang").alias("a"), "w").join(w.select(F.col("lang").alias("b"), "w"), "w").where(F.col("a") < F.col("b")).groupBy("a", "b").agg(F.count("*").alias("shared"))
    a, b = sizes.select(F.col("lang").alias("a"), F.col("n").alias("x")), sizes.select(F.col("lang").alias("b"), F.col("n").alias("y"))
    return a.join(b, F.col("a") < F.col("b")).join(shared, ["a", "b"], "left").select("a", "b", F.coalesce("shared", F.lit(0)).alias("shared"), (F.col("x") + F.col("y") - F.coalesce("shared", F.lit(0))).alias("either"))
