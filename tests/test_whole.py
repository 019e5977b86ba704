"""Queries over whole texts and pages, on small tables."""

import __spark_entry__ as E
from corpusmill.plans import registry


def put(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_entry_has_the_whole_content_of_pages(spark, tmp_path, monkeypatch):
    html = "<html lang='en'><body><h1>A <b>title</b></h1><article><p>First <i>marked</i> paragraph.</p><p>Second one.</p><p>Third, unclosed<p>Fourth<p>Fifth<ul><li>An item</li></ul></article></body></html>"
    put(spark, tmp_path, "pages", [(1, "https://a.b/1", html)], "page_id long, url string, html string")
    put(spark, tmp_path, "conversations", [(7, 0, "user", "hello")], "conv_id long, turn long, role string, text string")
    put(spark, tmp_path, "documents", [(3, "a text", "en", "s")], "doc_id long, text string, lang string, source string")
    put(spark, tmp_path, "benchmark", [(4, "an article")], "item_id long, text string")
    monkeypatch.setattr(E, "SMOKE_DIR", str(tmp_path))
    got = {r.source_type: r for r in E.entry(spark).collect()}
    assert len(got) == 4
    assert (got["wiki"].content, got["wiki"].category, got["wiki"].language) == ("an article", "Part 1", "tt")
    assert got["news"].title == "A title"
    assert all(x in got["news"].content for x in ("First marked paragraph.", "Second one.", "Third, unclosed", "Fourth", "Fifth", "An item"))


def test_words_after_the_first_200_characters_count(spark, tmp_path):
    rows = [(1, "a " * 150 + "late", "en", "s"), (2, "b " * 150 + "late", "fr", "s")]
    put(spark, tmp_path, "documents", rows, "doc_id long, text string, lang string, source string")
    assert [tuple(r) for r in registry.queries()["word_set_algebra"](spark, str(tmp_path)).collect()] == [("en", "fr", 1, 3)]
