"""Operators that no registered query shows whole: sources, sinks, configuration, streams, near duplicates."""

import bz2
import io
import json
import random
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import config, dedup, graph, metrics, social, unify
from corpusmill.sources import files, folders
from corpusmill.sources.store import KeyedStore
from corpusmill.streaming import landed


def test_first_wins(spark):
    rows = [("u1", "a", 0, 1), ("u1", "b", 2, 0), ("", "c", 3, 5), ("", "c", 3, 4), ("", "", 1, 9), (None, None, 1, 8)]
    df = spark.createDataFrame(rows, "url string, content string, source_rank int, seq int")
    got = dedup.first_wins(df, dedup.corpus_key(), ["source_rank", "seq"]).collect()
    assert sorted((r.url, r.content, r.seq) for r in got) == [("", "c", 4), ("u1", "a", 1)]


def test_first_wins_leaves_one_of_rows_alike_in_order(spark):
    rows = [("k", 0, "b"), ("k", 0, "a"), ("k", 0, "a"), ("k", 1, "z"), ("m", 0, "a"), ("m", 0, "a"), (None, 0, "x")] * 2
    df = spark.createDataFrame(rows, "k string, at int, v string")
    assert sorted(map(tuple, dedup.first_wins(df, F.col("k"), ["at"]).collect())) == [("k", 0, "a"), ("m", 0, "a")]
    assert dedup.first_wins(df.limit(0), F.col("k"), ["at"]).collect() == []
    maps = df.withColumn("m", F.create_map("k", "v")).where("k is not null")
    assert sorted((r.k, r.v, r.m[r.k]) for r in dedup.first_wins(maps, F.col("k"), ["at"]).collect()) == [("k", "a", "a"), ("m", "a", "a")]


def test_greedy_near_duplicates_keep_what_a_scan_keeps(spark):
    files.ensure_checkpoint_dir(spark)
    rng = random.Random(1)
    rows = [(i, [rng.randrange(40) for _ in range(2)]) for i in range(60)]
    kept = []
    for i, bands in rows:
        if not any(set(bands) & set(b) for b in kept):
            kept.append(bands)
    retained = [i for i, bands in rows if bands in kept and all(not set(bands) & set(b) for b in kept[: kept.index(bands)])]
    got = dedup.greedy_near_duplicates(spark.createDataFrame(rows, "id long, band array<long>"), "id").where("retained").collect()
    seen, want = [], []
    for i, bands in rows:
        if not any(set(bands) & set(b) for b in seen):
            seen.append(bands)
            want.append(i)
    assert sorted(r.id for r in got) == want and retained


def test_minhash_bands_find_near_copies(spark):
    rng = random.Random(2)
    a = " ".join(rng.choice("alpha beta gamma delta epsilon zeta".split()) + str(rng.randrange(999)) for _ in range(300))
    rows = [(1, a), (2, a + " tail"), (3, a[::-1]), (4, a[:400]), (5, None)]
    got = {r.id: set(r.band) for r in dedup.minhash_bands(spark.createDataFrame(rows, "id long, text string"), "text").collect()}
    assert set(got) == {1, 2, 3} and got[1] & got[2] and not got[1] & got[3]


def test_jsonl_skips_what_is_broken(spark, tmp_path):
    (tmp_path / "vk_a_posts.jsonl").write_text('{"url":"u","author":7,"extra":1}\n\n{bad\n{"content":"é"}\n')
    schema = "url string, author string, content string"
    rows = files.read_jsonl(spark, str(tmp_path), schema, glob="vk_*.jsonl").withColumn("d", files.vk_domain(files.file_name())).collect()
    assert sorted((r.url or "", r.author, r.content, r.d) for r in rows) == [("", None, "é", "a"), ("u", "7", None, "a")]
    assert files.read_jsonl(spark, str(tmp_path / "none"), schema).count() == 0
    out = str(tmp_path / "out")
    files.write_jsonl(spark.createDataFrame([("u", None)], "url string, author string"), out)
    assert [json.loads(r.value) for r in spark.read.text(out).collect()] == [{"url": "u", "author": None}]


def test_wiki_dump_reads_compressed(spark, tmp_path):
    xml = "<mediawiki><page><title>A b</title><ns>0</ns><revision><text>'''x'''</text></revision></page><page><title>T</title><ns>1</ns><revision><text>t</text></revision></page></mediawiki>"
    (tmp_path / "ttwiki-latest.xml.bz2").write_bytes(bz2.compress(xml.encode()))
    rows = files.read_wiki(spark, str(tmp_path / "ttwiki-latest.xml.bz2")).collect()
    assert sorted((r.title, r.ns, r.text) for r in rows) == [("A b", 0, "'''x'''"), ("T", 1, "t")]
    names = spark.createDataFrame([("ttwiki-latest_all.jsonl",)], "n string").select(files.wiki_language(F.col("n")).alias("l")).first()
    assert names.l == "tt"


def test_folder_with_nested_archives(spark, tmp_path):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("deep.txt", "inner")
        z.writestr("../out.txt", "leaves")
    with tarfile.open(tmp_path / "pack.tar", "w") as t:
        for name, data in (("a.zip", inner.getvalue()), ("b.txt", "Привет".encode("cp1251")), ("c.exe", b"x")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    (tmp_path / "plain.txt").write_text("plain")
    (tmp_path / ".hidden.txt").write_text("no")
    (tmp_path / "broken.zip").write_text("no archive")
    df = files.expand_archives(files.read_folder(spark, f"file:{tmp_path}"))
    got = {r.path.rsplit("/", 1)[-1]: r.t for r in df.select("path", files.decode_text("content").alias("t")).collect()}
    assert got == {"plain.txt": "plain", "pack.tar!a.zip!deep.txt": "inner", "pack.tar!b.txt": "Привет"}


def test_what_archives_leave_out_is_said(spark, tmp_path):
    import gzip

    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("big.txt", b"0" * 5000)
        z.writestr("small.txt", b"1" * 10)
        z.writestr("/abs.txt", b"2")
    bomb = gzip.compress(b"0" * 5000)
    found = {n: (None if d is None else len(d), why) for n, d, why in files.members("a.zip", inner.getvalue(), most=1000)}
    assert found == {"big.txt": (None, "over 1000 bytes"), "small.txt": (10, None), "/abs.txt": (None, "outside the archive")}
    assert [(n, d, w) for n, d, w in files.members("b.txt.gz", bomb, most=1000)] == [("b.txt", None, "over 1000 bytes")]
    assert [w for _, _, w in files.members("a.zip", inner.getvalue(), count=1)] == [None, "over 1 files"]
    assert [w for _, _, w in files.members("c.zip", b"no archive")][0].startswith("broken") and [w for _, _, w in files.members("c.gz", bomb[:40])][0].startswith("broken")
    deep = inner.getvalue()
    for i in range(4):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr(f"l{i}.zip", deep)
        deep = out.getvalue()
    (name, _, why) = next(files.members("deep.zip", deep))
    assert why == "too deep" and name.count("!") == 2
    (tmp_path / "a.zip").write_bytes(inner.getvalue())
    rows = files.expand_archives(files.read_folder(spark, f"file:{tmp_path}"), left_out=True).collect()
    assert [(r.path.rsplit("/", 1)[-1], r.reason) for r in rows] == [("abs.txt", "outside the archive")]
    assert files.corpus_name("tt", "20240101_000000") == "corpus_tt_20240101_000000.jsonl" and len(files.ENCODINGS) == 9


def test_sinks_keep_and_refuse(spark, tmp_path):
    df = spark.createDataFrame([(1, "latin"), (2, "other")], "i int, alphabet string")
    folders.write_by_alphabet(df, str(tmp_path / "o"))
    assert spark.read.json(str(tmp_path / "o/all")).count() == 2 and spark.read.json(str(tmp_path / "o/by_alphabet")).count() == 1
    files.write_table(df, str(tmp_path / "t"))
    files.write_table(df.limit(0), str(tmp_path / "t"), keep=True)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_table(df, str(tmp_path / "t"))
    assert spark.read.csv(str(tmp_path / "t"), header=True).count() == 2


def test_config_merging_and_resolution(spark, tmp_path):
    base = {"a": {"x": 1, "l": [1]}, "n": 5}
    assert config.merged(base, {"a": {"l": [2], "y": 2}, "n": None}) == {"a": {"x": 1, "l": [1, 2], "y": 2}, "n": None}
    assert base == {"a": {"x": 1, "l": [1]}, "n": 5}
    (tmp_path / "b.yaml").write_text("defaults: {title_selectors: [h1], author_strategy: [meta]}\nlanguages: {ru: {noise_words: [реклама], author_regex: [x]}}\n")
    (tmp_path / "u.yaml").write_text("includes: [b.yaml, missing.yaml]\nsites:\n  s: {match: [ria.ru, Z.ru], default_language: ru, noise_language: [ru, common], title_selectors: ['.t', h1], author_strategy: []}\n")
    loaded = config.load(str(tmp_path / "u.yaml"))
    site = config.resolve(loaded, "s")
    assert site["title_selectors"] == [".t", "h1"] and site["author_strategy"] == ["meta"] and site["noise_words"] == ["реклама"]
    assert site["author_patterns"] == ["x"] and site["verify_ssl"] is True and config.resolve(loaded, "none")["amp_mode"] == "none"
    assert sorted(r.pattern for r in config.site_patterns(spark, loaded).collect()) == ["ria.ru", "z.ru"]
    families = {"wp": {"indicators": {"wp-content": 2, "wp-json": 1}, "min_score": 2}, "drupal": {"indicators": {"drupal": 3}, "min_score": 3}}
    pages = spark.createDataFrame([("wp-content drupal",), ("wp-json",), ("wp-content wp-json",)], "h string")
    assert [r.f for r in pages.select(config.family(F.col("h"), families).alias("f")).collect()] == ["drupal", None, "wp"]


def test_social_threads_and_fallback(spark):
    c = spark.createDataFrame([(1, "root", [(2, "reply")]), (3, "alone", [])], "comment_id long, content string, thread array<struct<comment_id:long,content:string>>")
    assert sorted(r.comment_id for r in social.flatten_threads(c).collect()) == [1, 2, 3]
    found = spark.createDataFrame([("u", "t", None), ("v", "", "d")], "url string, title string, date string")
    got = unify.with_fallback(spark.createDataFrame([("u", "", "2024")], "url string, title string, date string"), found, fields=("title", "date")).collect()
    assert sorted((r.url, r.title, r.date) for r in got) == [("u", "t", "2024"), ("v", None, "d")]
    cats = spark.createDataFrame([("u", ["a", "b"])], "url string, category array<string>")
    assert unify.unify(cats, "news").first().category == "a"


def test_crawl_keeps_least_depths_and_a_cap(spark):
    files.ensure_checkpoint_dir(spark)
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "a"), ("c", "d"), ("x", "y"), ("d", None)], "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("a",)], "url string")
    assert sorted(map(tuple, graph.crawl(links, seeds).collect())) == [("a", 0), ("b", 1), ("c", 1), ("d", 2)]
    assert [tuple(r) for r in graph.crawl(links, seeds, max_pages=2).collect()] == [("a", 0), ("b", 1)]


def test_rouge_l_and_truncation(spark):
    assert metrics.lcs("a b c d a".split(), "b x c a".split()) == 3 and metrics.lcs([], ["a"]) == 0
    df = spark.createDataFrame([("a b c d", "b d e"), (None, "x")], "a string, b string")
    assert [r.r for r in df.select(metrics.rouge_l("a", "b").alias("r")).collect()] == [0.5714, 0.0]
    assert spark.range(1).select(X.truncate(F.lit("ab cd ef"), 4).alias("t")).first().t == "ab…"


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rows = [{"url": "u", "n": 1, "at": "2024-01-01T00:00:00"}, {"url": "u", "n": 2, "at": "2024-01-01T00:10:00"}, {"url": "v", "n": 3, "at": "2024-01-01T01:00:00"}]
    (src / "a.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows) + "{bad\n")
    stream = landed.read_jsonl_stream(spark, str(src), "url string, n long, at timestamp")
    for name, df in (("firsts", landed.first_by_key(stream, F.col("url"), "at")), ("counts", landed.counts_by_window(stream, "at", "url"))):
        q = df.writeStream.format("memory").queryName(name).outputMode("append" if name == "firsts" else "complete").trigger(availableNow=True).start()
        q.awaitTermination(60)
        assert q.exception() is None
    assert sorted(r.url for r in spark.table("firsts").collect()) == ["u", "v"]
    assert sorted((r.url, r.n) for r in spark.table("counts").collect()) == [("u", 2), ("v", 1)]
    for _ in range(2):
        landed.resume(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "url", 4).awaitTermination(60)
    landed.resume(stream, str(tmp_path / "out"), str(tmp_path / "cp2"), "url", 4).awaitTermination(60)  # every batch again
    store = KeyedStore(spark, str(tmp_path / "out"), "url string, n long, at timestamp", "url", 4)
    assert sorted(r.url for r in store.versions().collect()) == ["u", "v"] == sorted(r.url for r in store.table().collect())


def test_one_document_of_items_and_file_statistics(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "b")], "i int, t string")
    files.write_items(df, str(tmp_path / "items"))
    (line,) = [r.value for r in spark.read.text(str(tmp_path / "items")).collect()]
    assert sorted(json.loads(line)["items"], key=str) == [{"i": 1, "t": None}, {"i": 2, "t": "b"}]
    with pytest.raises(ValueError, match="too many"):
        files.write_items(df, str(tmp_path / "more"), most=1)
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / files.output_name("s", "2024-01-01")).write_text("a\nb\n")
    assert [tuple(r) for r in files.file_statistics(spark, str(tmp_path / "logs")).collect()] == [("s_2024-01-01_articles.jsonl", 2, 0.0)]


@pytest.mark.parametrize("n, run", [(10_000, dedup.RUN), (100, 40)])
def test_chains_of_near_duplicates_are_settled_in_few_rounds(spark, n, run):
    """Chains, thick chains in which each row is like the two before it, and a group of copies."""
    files.ensure_checkpoint_dir(spark)
    rows = [(i, [i, i + 1]) for i in range(n)] + [(20_000 + i, [-i - 1, -i - 2, -i - 3]) for i in range(n // 4)] + [(50_000 + i, [1 << 40]) for i in range(500)] + [(90_000, [7 << 40])]
    spark.sparkContext.setJobGroup("chain", "chain")
    got = {r.id: r.retained for r in dedup.greedy_near_duplicates(spark.createDataFrame(rows, "i long, band array<long>"), "i", run).collect()}
    kept, want = set(), {}
    for i, bands in sorted(rows):
        want[i] = not kept & set(bands)
        if want[i]:
            kept |= set(bands)
    assert got == want
    if run > 1000:
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain")) < 60


def test_first_wins_keeps_rows_with_a_null_order(spark):
    from pyspark.sql import functions as F

    from corpusmill.operators import dedup

    df = spark.createDataFrame([("a", None, "x"), ("a", 3, "y"), ("b", 2, "z"), ("b", 5, "z")], "k string, seq long, v string")
    assert sorted((r.k, r.v) for r in dedup.first_wins(df, F.col("k"), ["seq"]).collect()) == [("a", "x"), ("b", "z")]
