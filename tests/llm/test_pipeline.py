"""The pipeline stage by stage against plain versions of its decisions."""

import pytest
from pyspark.sql import functions as F
from test_packing import lawful
from test_pii import base
from test_resemble import plain_stage

import corpus_pipeline as P
from corpusmill.llm import langid
from corpusmill.llm.common import table


def test_stages_keep_and_drop_what_they_should(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    kept = {}
    for name, stage in P.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = stage(spark, docs, sf)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == P.COLUMNS
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        if name == "language":
            assert set(kept[name]) == {i for i, t in before if langid.has_letter(t)}
        elif name == "toxicity":
            gone = {i for i, _ in before} - set(kept[name])
            assert all(labels.get(i, 1) == 1 for i in gone)
        elif name == "near_duplicates":
            assert sorted(kept[name]) == plain_stage(before)
        else:
            assert set(kept[name]) == set(kept["near_duplicates"])
            for i, t in before:
                found = base(t or "")
                assert not found or kept[name][i] != t
                assert all((t or "")[a:b] not in kept[name][i] for k, a, b in found if k in (0, 3))
    packed = P.STAGES[-1][1](spark, docs, sf).collect()
    lawful(packed, list(kept["pii"].items()), 4096)


def test_run_is_the_stages_in_turn(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf_dir)
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, P.run(spark, sf_dir).collect())) == sorted(map(key, docs.collect()))


@pytest.mark.parametrize("stage", range(4))
def test_odd_rows_pass_each_stage(spark, sf_dir, stage):
    rows = [(1, None, None, None, None), (None, "words without id", "en", "s", 16), (None, "words without id", "en", "s", 16), (2, "same text here", None, "s", 14), (2, "same text here", None, "s", 14), (3, "", "en", None, 0), (2, "another text with that id", "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit(1)).withColumn("fp", F.lit(2))
    _, run = P.STAGES[stage]
    out = run(spark, df.select(*P.COLUMNS), sf_dir).collect()
    if stage == 2:
        assert sorted((str(r.doc_id), r.text) for r in out) == [("1", None), ("2", "another text with that id"), ("2", "same text here"), ("None", "words without id")]
    else:
        assert len(out) == {0: 5, 1: 7, 3: 7}[stage]
    assert run(spark, df.select(*P.COLUMNS).limit(0), sf_dir).count() == 0
