"""Extraction by a site's rules on small pages."""

from pyspark.sql import functions as F

from corpusmill.functions import html as H, siterules as R
from corpusmill.operators import config

PAGE = """<html><head><title>Site</title><meta name="author" content="admin"><meta property="article:section" content="Культура и быт">
<script type="application/ld+json">{"datePublished": "2024-03-15", "author": [{"@type": "Person", "name": "Ali Vali"}], broken</script></head>
<body><nav><a href="/culture/">C</a><a href="/sport/">S</a><a href="mailto:x">m</a><a href="/culture/">again</a></nav><header><a href="https://b.tj/">other</a></header>
<span style="font: byline">By Gali Gali</span><div id="text"><p>Written by Someone Else</p><p>реклама here</p><p class="cut">cut me</p><p>Kept text.</p></div><a href="/news/1">one</a>
<script>window.s = {"path": "/rubric/7", "url": "https://a.tj/tag/x"}</script></body></html>"""
URL = "https://a.tj/culture/news/1"


def page(**rules):
    return R.SitePage(PAGE, URL, R.Rules(**rules))


def test_each_author_strategy():
    found = {s: page(default_author="Desk").author(s) for s in R.AUTHOR_STRATEGIES}
    assert found["meta_tag"] == "admin" and found["class_selector"] is None and found["style_based"] == "By Gali Gali"
    assert found["json_ld_graph"] == found["json_ld_simple"] == "Ali Vali"  # by pattern: the block can't be parsed
    assert found["regex_in_content"] is not None and found["priority_list"] is None and found["default_fallback"] == "Desk"


def test_dates_categories_and_content():
    p = page(content_selectors=("#text",), remove_selectors=(".cut",), noise_words=("Реклама",))
    assert p.dates() == ["2024-03-15"] and p.category() == ["Культура и быт"]
    assert p.content() == "Written by Someone Else\nKept text."


def test_links_to_rubrics():
    assert page().rubrics() == ["https://a.tj/culture/", "https://a.tj/sport/", "https://b.tj/"]
    assert page(rubric_selectors=("nav a",), rubric_strategy=("auto_detect_multi",)).rubrics() == ["https://a.tj/culture/", "https://a.tj/sport/", "https://a.tj/news/1"]
    assert page(rubric_strategy=("pattern_fallback",)).rubrics() == ["https://a.tj/news/1"]
    assert {"https://a.tj/rubric/7", "https://a.tj/tag/x"} <= set(page(rubric_strategy=("nuxt_state_parsing",)).rubrics())
    assert page(rubric_strategy=("context_passed", "menu_scraping")).rubrics() == [URL]


def test_gates_choose_in_the_order_of_strategies(spark):
    site = config.resolve({"sites": {"s": {"match": ["a.tj"], "content_selectors": ["#text"]}}}, "s")
    df = spark.createDataFrame([(PAGE, URL), (None, None), ("", "https://a.tj/category/Sport/x")], "html string, url string")
    rows = df.select(R.given("html", "url", F.lit("s"), {"s": R.Rules.of(site)}).alias("g"), "url").select(R.accepted_author("g.authors").alias("a"), R.accepted_category("url", "g.categories", by_url=True).alias("c"), "g.title").collect()
    assert (rows[0].a.strategy, rows[0].a.value) == ("style_based", "Gali Gali") and rows[0].title == "Site" and rows[0].c == "Культура и быт"
    assert rows[1].a is None and rows[1].c is None and rows[2].c == "Sport"


def test_reference_text():
    long = "word " * 70
    assert H.gold_body(H.parse(f"<div class='post-content'>short</div><div role='main'>{long}<script>x</script></div>")) == long.strip()
    assert H.gold_body(H.parse(f"<div class='news-single'><div class='content'>{long}</div></div><article>{long}{long}</article>")) == long.strip()
    assert H.gold_body(H.parse("<body><nav>menu</nav><p>left</p><footer>f</footer></body>")) == "left" and H.gold_body(H.parse("")) == ""
