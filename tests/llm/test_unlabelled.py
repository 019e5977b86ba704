"""The language stage where no document has a language to learn from."""

import corpus_pipeline as P


def test_documents_without_any_lang_stay(spark):
    rows = [(1, "plain words", None, "s", 11), (2, "123 ...", None, "s", 7), (3, None, None, "s", None), (4, "", None, "s", 0), (5, "é", None, "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id, r.text, r.lang) for r in P.identify_language(spark, df, "").collect()) == [(1, "plain words", None), (5, "é", None)]
