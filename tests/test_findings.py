"""Findings of the reviews, each by a small input that showed it."""

import duckdb

from corpusmill.plans import registry


def beside_sql(spark, tmp_path, name, table, rows, schema):
    """The rows of a query and those of its SQL over a small table."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    key = lambda r: repr(r)
    return sorted(map(tuple, registry.queries()[name](spark, str(tmp_path)).collect()), key=key), sorted(con.execute(registry.oracle_sql()[name]).fetchall(), key=key)


def test_headings_with_references_cut_short(spark, tmp_path):
    texts = ["a&amp;&amp; b&amp", "t = &quot;0b9", "x &lt y &amp;lt; z", " \n &amp; \xa0 q ", " ", "&copy", "a<b>c</b>"]
    pages = [f"<html><head><title>other</title></head><h1>{t}</h1><h1>second</h1></html>" for t in texts] + ["<h1 class='k'>k</h1>", "", None]
    got, want = beside_sql(spark, tmp_path, "html_h1_title", "pages", [(i, "http://a.b/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    assert got == want and (0, "a&& b&amp") in got


def test_scripts_by_counts_taken_once(spark):
    from corpusmill.functions import scripts

    texts = ["", None, "abв", "aв", "авЖ z", "кирİ", "سلامab", "سل ab", "سلام", "123 —", "Ққ😀", "ӣq", "K"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", scripts.script("t").alias("s"))
    spans = {"latin": "a-z", "cyrillic": scripts.CYRILLIC_PLAIN}

    def plain(t):
        n = {k: sum(c in scripts.spelled(v) for c in (t or "").lower()) for k, v in spans.items()}
        ara = sum("؀" <= c <= "ۿ" for c in t or "")
        return "arabic" if ara > max(n.values()) else "cyrillic" if n["cyrillic"] > n["latin"] else "latin" if n["latin"] else "unknown"

    assert [r.s for r in df.collect()] == [plain(t) for t in texts]
    shown = df._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in shown and shown.count("translate(") == 3


def test_pages_are_parsed_one_by_one_and_given_away_in_blocks(monkeypatch):
    import gc
    import weakref

    import pyarrow as pa

    from corpusmill.functions import html as H

    held = []
    monkeypatch.setattr(H.F, "arrow_udf", lambda run, ddl: run)
    monkeypatch.setattr(H, "BLOCK_CHARS", 1000)
    run = H.by_page(lambda h: held.append(h) or {"a": h}, "struct<a:string>")
    blocks = list(run(iter([pa.array([f"<p>{i}</p>" * 9 for i in range(100)] + [None])])))
    assert sum(map(len, blocks)) == 101 and max(map(len, blocks)) < 12 and blocks[-1].to_pylist()[-1] == {"a": None}

    class Seen(H.Page):
        made = []

        def __init__(self, html, url):
            super().__init__(html, url)
            self.mark = lambda: None
            self.root.attrs["mark"] = self.mark
            self.made.append(weakref.ref(self.mark))

    monkeypatch.setattr(H, "Page", Seen)
    gc.disable()
    try:
        H.facts("<div><p>a</p><p>b</p></div>", "http://a.b/", ("title", "links"))
        assert Seen.made[0]() is None  # nothing is left for the collector
    finally:
        gc.enable()


def test_strategy_scores_count_pages_without_an_id_and_with_the_same(spark, tmp_path):
    rows = [(1, "http://a.b/1", "<title>t</title><h1>T</h1>"), (1, "http://a.b/2", "<h1>x</h1>"), (None, "http://a.b/3", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    scores = registry.queries()["html_strategy_scores"](spark, str(tmp_path)).collect()
    assert all(r.attempts == 3 for r in scores) and next(r for r in scores if r.field == "title").correct == 2


def test_words_are_remembered_as_arrow_strings_and_give_the_tokenizers_ids():
    import numpy as np

    from corpusmill.llm import packing

    w = packing.WordCache("word_bpe_49k.json")
    texts = ["Ab ab, AB!! x1 ünd Ünd.", "", "ab, ünd. y2&& Ab,, new New. ,, 中文 a1.b", "new, x1 NEW.\nab  Ab"]
    for _ in range(2):  # learned, then remembered
        for i in range(0, len(texts), 2):
            ids, offs = w.encode(texts[i : i + 2])
            got = [ids[a:b].tolist() for a, b in zip(offs, offs[1:])]
            assert got == [w.tokenizer.encode(t, add_special_tokens=False).ids for t in texts[i : i + 2]]
    assert not w.index and len(w.known) == w.remembered() == len(set(w.known.to_pylist())) and isinstance(w.start, np.ndarray)


def test_tokens_by_words_are_those_of_whole_texts(spark):
    from tokenizers import Tokenizer

    from corpusmill.operators import metrics
    from corpusmill.plans.documents import TOKENIZER

    made = Tokenizer.from_file(TOKENIZER)
    assert metrics.splits_at_space(made)
    texts = ["a\r\nb\tc", "", "  x  \n", "ﬁ İK ss", "x<|endoftext|>y <|endoftext|> <| endoftext |>", "don't can't.,'s we'LL", ".\n.", "Ab,, ab AB!! é é́ é ́x", "12.5% №7&& 中文。ok", "a\xa0b c d", "x'&s it's&& '"]
    seen, memory = [], {}
    encode = lambda some: seen.extend(some) or made.encode_batch_fast(some, add_special_tokens=False)
    for _ in range(2):
        assert metrics.lengths_by_words(texts, memory, encode).tolist() == [len(made.encode(t, add_special_tokens=False).ids) for t in texts]
    assert len(seen) == len(set(seen))  # each word is encoded once


def test_minhash_in_cells_gives_what_whole_passes_give(monkeypatch):
    import numpy as np
    import pandas as pd

    from corpusmill.operators import dedup

    texts = pd.Series(["abcde", "abc", None, "x" * 50, " ".join(map(str, range(3000))), "é😀" * 9 + "q"])
    rng = np.random.default_rng(1)
    a, b = rng.integers(1, 2**63, 12, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**63, 12, dtype=np.uint64)
    mix = rng.integers(1, 2**63, 4, dtype=np.uint64) | np.uint64(1)
    for cells in (64, dedup.CELLS):
        monkeypatch.setattr(dedup, "CELLS", cells)
        for t, got in zip(texts, dedup._bands(texts, 3, 4, 5)):
            if t is None or len(t) < 5:
                assert got is None
                continue
            h = dedup._shingle_hashes(t, 5)
            least = np.array([((h * x + y) >> np.uint64(8)).min() for x, y in zip(a, b)], np.uint64)
            assert got.tolist() == (least.reshape(3, 4) * mix).sum(1, dtype=np.uint64).view(np.int64).tolist()
