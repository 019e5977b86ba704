"""Registered queries without SQL against plain loops over the same rows."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import html as H, text as X
from corpusmill.operators import dedup, metrics
from corpusmill.plans import documents as D, registry
from corpusmill.plans.registry import table


def run(name, spark, sf_dir):
    return registry.queries()[name](spark, sf_dir).collect()


def longest(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        last = 0
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], last + 1 if a == b else max(row[j], row[j - 1])
    return row[-1]


def test_rouge_l(spark, sf_dir):
    got = {r.doc_id: r.rouge_l for r in run("rouge_l_f1", spark, sf_dir)}
    rows = D.pairs(spark, sf_dir).select("doc_id", X.tokens("text").alias("x"), X.tokens("gold").alias("y")).collect()
    assert len(got) == len(rows) and any(got.values())
    short = [r for r in rows if len(r.x) * len(r.y) < 60_000]
    assert len(short) > 50
    for r in short:
        n = longest(r.x, r.y)
        assert got[r.doc_id] == pytest.approx(2 * n / (len(r.x) + len(r.y)) if n else 0.0, abs=1e-4)


def test_near_duplicates_by_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where(F.length(F.trim("text")) >= 50)
    first = {}
    for r in docs.select("doc_id", "source", "text", X.normal_form("text").alias("form")).orderBy("doc_id").collect():
        first.setdefault((r.source, r.form), (r.doc_id, r.source, r.text))
    bands = {r.doc_id: set(r.band) for r in dedup.minhash_bands(spark.createDataFrame(list(first.values()), "doc_id long, source string, text string"), "text").collect()}
    kept, base, near = defaultdict(list), Counter(), Counter()
    for doc_id, source, _ in sorted(first.values()):
        if doc_id in bands:
            base[source] += 1
            if any(bands[doc_id] & b for b in kept[source]):
                near[source] += 1
            else:
                kept[source].append(bands[doc_id])
    got = {r.source: (r.near_dup_base, r.near_dups) for r in run("near_dup_rate", spark, sf_dir)}
    assert got == {s: (n, near[s]) for s, n in base.items()}


def test_tokenizer_counts(spark, sf_dir):
    from tokenizers import Tokenizer

    made, want = Tokenizer.from_file(D.TOKENIZER), defaultdict(lambda: [0, 0, 0])
    for r in table(spark, sf_dir, "documents").select("source", "text").collect():
        for i, n in enumerate((1, len(r.text), len(made.encode(r.text, add_special_tokens=False).ids))):
            want[r.source][i] += n
    assert {r.source: [r.docs, r.chars, r.tokens] for r in run("tokenizer_counts", spark, sf_dir)} == dict(want)
    empty = spark.createDataFrame([("a", None), ("a", "")], "g string, text string")
    assert [tuple(r) for r in metrics.tokenizer_counts(empty, ["g"], D.TOKENIZER).collect()] == [("a", 2, 0, 0, 0.0)]


def test_page_queries_give_each_page_what_a_loop_gives(spark, sf_dir):
    pages = {r.page_id: r for r in table(spark, sf_dir, "pages").collect()}
    facts = {i: H.facts(p.html, p.url) for i, p in pages.items()}
    assert {(r.page_id, r.page_type, r.container) for r in run("html_page_type", spark, sf_dir)} == {(i, f["page_type"], f["container"]) for i, f in facts.items()}
    assert {(r.page_id, r.pos, r.tag, r.text) for r in run("html_block_text", spark, sf_dir)} == {(i, n, b["tag"], b["text"]) for i, f in facts.items() for n, b in enumerate(f["blocks"])}
    assert {(r.page_id, r.gold_len) for r in run("html_gold_body", spark, sf_dir)} == {(i, len(f["gold"])) for i, f in facts.items()}
    scores = run("html_strategy_scores", spark, sf_dir)
    assert {(r.field, r.strategy) for r in scores} >= {("title", "selectors"), ("author", "meta_tag"), ("date", "json_ld")} and all(r.attempts == len(pages) for r in scores)


def test_lenient_dates_of_all_rows(spark, sf_dir):
    import re
    from datetime import datetime

    from dateutil import parser

    months = dict(zip("января февраля марта апреля мая июня июля августа сентября октября ноября декабря".split(), "January February March April May June July August September October November December".split()))

    def plain(value):
        t = " ".join((value or "").split())
        if not t:
            return None
        if m := re.fullmatch(r"(\d{4}-\d\d-\d\d)(?:[T ](\d\d:\d\d)(?::(\d\d))?)?(Z|[+-]\d\d:\d\d)?", t):
            return f"{m[1]}T{m[2] + ':' + (m[3] or '00') if m[2] else '00:00:00'}{(m[4] or '').replace('Z', '+00:00')}"
        for a, b in months.items():
            t = t.replace(a, b)
        try:
            return parser.parse(t, fuzzy=True, ignoretz=True, dayfirst=True, default=datetime(2024, 1, 1)).isoformat()
        except (ValueError, OverflowError):
            return t

    rows = registry.queries()["date_lenient_whole"](spark, sf_dir).collect()
    assert len(rows) == 200 and {r.doc_id % 7 for r in rows} == set(range(7))
    assert [r.parsed for r in rows] == [plain(r.value) for r in rows]
