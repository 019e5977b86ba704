"""Office files, pages over HTTP from a local server, and shapes of raw records."""

import io
import json
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import scripts
from corpusmill.operators import social
from corpusmill.sources import files, office, web


def packed(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), data)
    return out.getvalue()


WORD = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
DRAW = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'
SHEET = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
DOCX = packed(word__document_dot_xml=f"<w:document {WORD}><w:body><w:p><w:r><w:t>One</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:t>a</w:t></w:p></w:tc><w:tc><w:p><w:t>b</w:t></w:p></w:tc></w:tr></w:tbl></w:body></w:document>")
PPTX = packed(ppt__slides__slide1_dot_xml=f"<x {DRAW}><a:p><a:t>Hi</a:t></a:p></x>", ppt__slides__slide2_dot_xml=f"<x {DRAW}><a:p><a:t>Bye</a:t></a:p></x>")
XLSX = packed(xl__workbook_dot_xml=f'<workbook {SHEET}><sheets><sheet name="S1"/></sheets></workbook>', xl__sharedStrings_dot_xml=f"<sst {SHEET}><si><t>txt</t></si></sst>", xl__worksheets__sheet1_dot_xml=f'<worksheet {SHEET}><row><c t="s"><v>0</v></c><c/><c><v>4</v></c></row></worksheet>')
EPUB = packed(a_dot_xhtml="<p>second</p>", b_dot_xhtml="<p>first</p><script>no</script>", c_dot_opf='<package><manifest><item id="x" href="b.xhtml"/><item id="y" href="a.xhtml"/></manifest><spine><itemref idref="x"/><itemref idref="y"/></spine></package>')


def test_office_formats():
    assert office.extract("docx", "f", DOCX)[0] == "One\n[TABLE] a | b"
    assert office.extract("pptx", "f", PPTX)[0] == "=== Slide 1 ===\nHi\n=== Slide 2 ===\nBye"
    assert office.extract("xlsx", "f", XLSX)[0] == "=== S1 ===\ntxt\t4"
    assert office.extract("ebook", "f.epub", EPUB)[0] == "first\n\nsecond"
    assert office.extract("ebook", "f.fb2", b"<FictionBook><body><p>a <b>c</b></p></body></FictionBook>")[0] == "a c"
    assert office.extract("html", "f", b"<nav>x</nav><p>y</p>\n z")[0] == "y\nz"
    assert "error" in office.extract("docx", "f", b"broken")[1] and "no extractor" in office.extract("pdf", "f", b"")[1]["error"]


def test_document_records(spark, tmp_path):
    (tmp_path / "poems").mkdir()
    (tmp_path / "poems" / "Tukay_Shurale.txt").write_text("Шурале урманда яши. " * 20 + "\n© All mine\n")
    (tmp_path / "short.txt").write_text("x")
    df = office.documents(files.read_folder(spark, f"file:{tmp_path}"), f"file:{tmp_path}", "books")
    rows = {r.file_name: r for r in df.collect()}
    r = rows["Tukay_Shurale"]
    assert (r.author, r.title, r.category, r.language, r.skipped) == ("Tukay", "Shurale", "poems", "cyrillic", None)
    assert "©" not in r.content and r.quality.words_count == 60 and rows["short"].skipped == "short"
    assert sum(x.files for x in office.run_statistics(df).collect()) == 2


@pytest.fixture
def server():
    class Handler(BaseHTTPRequestHandler):
        tries: dict = {}

        def do_GET(self):
            n = Handler.tries[self.path] = Handler.tries.get(self.path, 0) + 1
            if self.path == "/robots.txt":
                body = b"User-agent: *\nDisallow: /private"
            elif self.path.startswith("/api/"):
                body = json.dumps({"data": [1] if int(self.path[5:]) <= 5 else []}).encode()
            elif self.path == "/flaky" and n < 2 or self.path == "/gone":
                return self.send_error(503)
            else:
                body = b"<h1>ok</h1>"
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_pages_are_fetched_with_retries_and_rules(spark, server):
    urls = [f"{server}/{x}" for x in ("a", "private/b", "gone", "flaky")]
    rows = {r.url.removeprefix(server): r for r in web.read_pages(spark, urls, delay=0, tries=2, robots=True).collect()}
    assert rows["/a"].html == "<h1>ok</h1>" and rows["/flaky"].error is None
    assert "robots" in rows["/private/b"].error and "503" in rows["/gone"].error
    amp = web.read_pages(spark, [f"{server}/gone"], delay=0, tries=1, amp="prefix").first()
    assert amp.html == "<h1>ok</h1>"
    assert web.read_pages(spark, []).count() == 0


def test_api_pages(spark, server):
    assert web.read_api(spark, server + "/api/{page}", "data", delay=0).count() == 5
    for n in range(9):
        assert web.last_page(lambda p, n=n: p <= n) == n
    assert web.at_path({"a": [{"b": 1}]}, "a.0.b") == 1 and web.at_path({"a": 1}, "a.b") is None
    with pytest.raises(ValueError, match="tries"):
        web.fetch("http://127.0.0.1:1", 0)


def test_raw_posts_and_comments(spark):
    post = {"id": 5, "owner_id": -1, "date": 1700000000, "text": "Ҷумҳурӣ 😀 " * 20, "likes": {"count": 3}, "attachments": [{"type": "video"}, {"type": "photo", "photo": {"sizes": [{"url": "s"}, {"url": "l"}]}}]}
    posts = social.vk_posts(spark.createDataFrame([("d", json.dumps(post)), ("d", json.dumps({"id": 6, "text": "short"}))], "domain string, body string"), language="tg")
    r = {x.post_id: x for x in posts.collect()}[5]
    assert (r.url, r.image_url, r.likes, r.views, r.time, len(r.title)) == ("https://vk.com/wall-1_5", "l", 3, 0, "22:13", 120)
    raw = [(5, json.dumps({"id": 1, "from_id": 9, "date": 1700000000, "text": "a long enough reply ғ", "parents_stack": []})), (5, json.dumps({"id": 2, "text": "another reply ҳ", "parents_stack": [1]})), (5, json.dumps({"id": 3, "text": "no"})), (5, json.dumps({"id": 4, "text": "in another language"}))]
    comments = social.vk_comments(spark.createDataFrame(raw, "post_id long, body string"))
    assert sorted((x.comment_id, x.parent_comment_id) for x in comments.collect()) == [(1, 0), (2, 1), (3, 0), (4, 0)]
    made = social.vk_unified(posts, comments, "tg", scripts.letters_fit("content", *scripts.LETTER_RULES["tg"])).collect()
    assert [(x.post_id, x.comments) for x in made] == [(5, "a long enough reply ғ\nanother reply ҳ")]
    t = social.telegram_posts(spark.createDataFrame([(7, 1700000000, "text", None, 2), (8, 0, None, 1, 1)], "id long, date long, text string, views long, forwards long"), "ch").collect()
    assert [(x.url, x.views, x.forwards) for x in t] == [("https://t.me/ch/7", 0, 2)] and isinstance(F.col("x"), object)
