"""Jobs over a small site on this machine and small folders."""

import bz2
import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from corpusmill import jobs
from corpusmill.__main__ import main
from corpusmill.functions import siterules as R
from corpusmill.sources import web

LONG = "A sentence of some length that stands in an article. " * 6
SITE = {
    "/": '<html><body><nav><a href="/rubric/a/">Rubric A</a><a href="/rubric/b/">Rubric B</a></nav><a href="/news/1">First article here</a></body></html>',
    "/rubric/a/": '<html><body><a href="/news/1">First again here</a><a href="/news/2">Second article here</a><a href="/rubric/a/page/2/">Next</a></body></html>',
    "/rubric/b/": '<html><body><a href="/news/3">Third article here</a><a href="https://other.example/news/9">Elsewhere</a><a href="/news/photo/">x</a></body></html>',
    "/rubric/a/page/2/": '<html><body><a href="/news/4">Fourth article here</a></body></html>',
    "/news/1": f'<html><head><meta property="og:title" content="Title one"><meta property="article:published_time" content="2024-03-15T10:30:00Z"><meta name="author" content="Ali Vali"></head><body><article><h1>One</h1><p>{LONG}</p></article></body></html>',
    "/news/2": "<html><body><p>short</p></body></html>",
    "/news/3": f'<html><head><title>Three</title></head><body><div class="byline">By Gali Gali</div><article><p>{LONG}</p></article></body></html>',
}


@pytest.fixture(scope="module")
def site():
    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            body = SITE.get(self.path)
            if body is None:
                return self.send_error(404)
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *args):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def fetch(df):
    return web.fetch_table(df, tasks=2, delay=0, tries=1)


def test_discover_and_extract_a_site(spark, site):
    found = jobs.discover(spark, site + "/", R.Rules(), fetch).cache()
    assert {r.url.removeprefix(site): r.title for r in found.collect()}.items() >= {"/news/1": "First article here", "/news/2": "Second article here", "/news/3": "Third article here", "/news/4": "Fourth article here"}.items()
    assert not any("other.example" in r.url for r in found.collect())
    got = {r.url.removeprefix(site): r for r in jobs.extract(found, R.Rules(), fetch).collect()}
    one = got["/news/1"]
    assert (one.title, one.date, one.author, one.time) == ("Title one", "2024-03-15T10:30:00+00:00", "Ali Vali", "30:00")  # the first H:MM after a word boundary, which the hour of an ISO time has not
    assert "A sentence of some length" in one.content and got["/news/3"].author == "Gali Gali"
    assert got["/news/2"].title == "Second article here" and "/news/4" not in got  # the page's own title is missing; the page is gone


def test_site_keys_and_starts():
    config = {"sites": {"a": {"match": ["b.tj"], "default_language": "tg"}, "z": {"match": ["news.b.tj"], "start_url": "https://news.b.tj/x", "default_language": "tt"}, "n": {"default_language": "tg"}}}
    assert [jobs.site_key(config, u) for u in ("https://www.b.tj/1", "https://news.b.tj/", "https://c.tj")] == ["a", "z", "default"]
    assert jobs.starts(config, "tg") == {"a": "https://b.tj"} and len(jobs.starts(config, "all")) == 2


def put(path, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows))


def test_corpus_of_collected_rows(spark, tmp_path):
    put(tmp_path / "news/s.jsonl", {"url": "u1", "title": " T ", "content": "news text"})
    put(tmp_path / "social/posts/vk_a_posts.jsonl", {"url": "u1", "content": "later source"}, {"url": "u2", "content": "post", "language": "ba"})
    put(tmp_path / "social/comments/vk_a_comments.jsonl", {"owner_id": -1, "post_id": 7, "content": "comment"})
    put(tmp_path / "social/posts/other.jsonl", {"url": "no", "content": "not a file of posts"})
    put(tmp_path / "social/telegram_x.jsonl", {"url": "tg", "content": "channel"})
    put(tmp_path / "social/rutube_x.jsonl", {"video_url": "v", "content": "Ali\n2 days ago\nFine"})
    put(tmp_path / "wiki/ttwiki-latest_all.jsonl", {"url": "w", "title": "W", "text": "article", "categories": ["One", "Two"]})
    put(tmp_path / "wiki/bawiki-latest_all.jsonl", {"url": "w2", "title": "W2", "text": "other language"})
    put(tmp_path / "documents/d.jsonl", {"content": "a document"}, {"content": "a document"})
    rows = {r.url or r.content: r for r in jobs.corpus(spark, str(tmp_path), "tt").collect()}
    assert set(rows) == {"u1", "u2", "https://vk.com/wall-1_7", "v", "w", "a document", "tg"}
    assert rows["tg"].source_type == "social_telegram"
    assert rows["u1"].source_type == "news" and rows["u1"].title == "T" and rows["u2"].language == "ba" and rows["v"].author == "Ali" and rows["v"].content == "Fine"
    assert (rows["w"].category, rows["w"].language, rows["w"].content) == ("One", "tt", "article")
    assert {r.source_type for r in jobs.corpus(spark, str(tmp_path), "tt", ("wiki",)).collect()} == {"wiki"}


def test_corpus_keeps_the_first_in_file_order_and_reads_list_categories(spark, tmp_path):
    same = {"url": "u", "title": "T", "content": "one", "category": ["A", "B"]}
    put(tmp_path / "news/b.jsonl", {"url": "u", "content": "a later file"}, *[{"url": f"n{i}", "content": f"z{i}", "category": c} for i, c in enumerate(["plain", [], None, [None, "x"], '["A"]', 7])])
    put(tmp_path / "news/a.jsonl", *[same] * 3, {"url": "u", "title": "A", "content": "a lesser row, later in the file"}, {"content": "no address"}, {"content": "no address", "title": "second"})
    put(tmp_path / "news/c.jsonl", *[{"url": f"c{i % 50}", "content": f"{9999 - i}"} for i in range(2000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # many blocks of a file
    try:
        rows = {r.url or r.content: r for r in jobs.corpus(spark, str(tmp_path), "tt", ("news", "docs", "wiki")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == jobs.corpus(spark, str(tmp_path), "tt").count() == 58
    assert (rows["u"].content, rows["u"].category) == ("one", "A") and rows["no address"].title == ""
    assert [rows[f"n{i}"].category for i in range(6)] == ["plain", None, None, None, '["A"]', "7"]
    assert all(rows[f"c{i}"].content == f"{9999 - i}" for i in range(50))


def test_verbs(spark, tmp_path, capsys):
    xml = f"<mediawiki><page><title>A b</title><ns>0</ns><revision><text>'''x''' {LONG}</text></revision></page><page><title>R</title><ns>0</ns><revision><text>#REDIRECT [[A]]</text></revision></page></mediawiki>"
    (tmp_path / "d.xml.bz2").write_bytes(bz2.compress(xml.encode()))
    assert main(["wiki", str(tmp_path / "d.xml.bz2"), "ttwiki", str(tmp_path / "wiki")]) == 0
    assert [r.url for r in spark.read.json(str(tmp_path / "wiki")).collect()] == ["https://tt.wikipedia.org/wiki/A_b"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a_b.txt").write_text(LONG)
    assert main(["docs", f"file:{tmp_path}/in", str(tmp_path / "docs")]) == 0
    assert [r.title for r in spark.read.json(str(tmp_path / "docs")).collect()] == ["b"]
    put(tmp_path / "vk/posts/vk_a_posts.jsonl", {"content": "Ҷумҳурӣ ва мардум", "post_id": 1, "domain": "a"}, {"content": "short", "post_id": 2})
    put(tmp_path / "vk/comments/vk_a_comments.jsonl", {"comment_id": 1, "post_id": 1, "content": "Ин ҷавоб ба навишта"}, {"comment_id": 2, "post_id": 1, "content": "in another language"})
    assert main(["build-vk", str(tmp_path / "vk"), str(tmp_path / "unified"), "tg"]) == 0
    assert [(r.post_id, r.comments) for r in spark.read.json(str(tmp_path / "unified")).collect()] == [(1, "Ин ҷавоб ба навишта")]
    (tmp_path / "c.yaml").write_text("sites: {s: {match: [a.tj], default_language: tg}}\n")
    assert main(["config", "https://a.tj/x", str(tmp_path / "c.yaml")]) == 0 and '"site_key": "s"' in capsys.readouterr().out
    assert main([]) == 2 and main(["wiki"]) == 2
