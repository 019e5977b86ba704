"""The curve's laws, and shards' laws on odd tables."""

import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import sharding as S
from corpusmill.llm.common import table


@pytest.mark.parametrize(("n", "bits"), [(2, 3), (3, 2), (3, 3)])
def test_the_curve_visits_every_cell_and_moves_one_step(spark, n, bits):
    cells = list(itertools.product(range(1 << bits), repeat=n))
    df = spark.createDataFrame(cells, [f"x{i}" for i in range(n)])
    rows = df.withColumn("h", S.hilbert([F.col(f"x{i}") for i in range(n)], bits)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(len(cells)))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[i] - b[i]) for i in range(n)) == 1


def lawful(rows, docs, law, shards=40):
    assert len(rows) == len(docs)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs)
    by = {}
    for r in rows:
        assert r.law == law and r.grown_shard is None and 0 <= r.shard < shards
        by.setdefault(r.shard, []).append(r)
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    counts = [len(by.get(s, [])) for s in range(shards)]
    if law == "rows":
        assert max(counts) - min(counts) <= 1
    order = [r.curve for s in sorted(by) for r in sorted(by[s], key=lambda r: r.slot)]
    assert order == sorted(order)
    return by


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_documents_keep_the_law(spark, sf_dir, law):
    df = table(spark, "/root/testdata/sf0.01", "documents")
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    by = lawful(S.assign(df, law=law).collect(), docs, law)
    if law == "bytes":
        sizes = [sum(r.size for r in by.get(s, [])) for s in range(40)]
        biggest = max(len(t.encode()) for _, t in docs) + 16
        assert max(sizes) <= sum(sizes) / 40 + biggest


def test_odd_rows(spark):
    rows = [(1, None, None, None), (None, "", "x", "en"), (2, "same", "x", "en"), (2, "same", "x", "en"), (3, "long " * 40_000, "y", None)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, lang string, curve string")
    for law in ("rows", "bytes"):
        lawful(S.assign(df, law=law).collect(), [r[:2] for r in rows], law)
        assert S.assign(df.limit(0), law=law).count() == 0


def test_shards_prune_on_every_dimension(spark, tmp_path):
    df = table(spark, "/root/testdata/sf0.1", "documents")
    S.write(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == df.count()
    spans = back.groupBy("shard").agg(F.min("lang").alias("a"), F.max("lang").alias("b"), F.min("n_chars").alias("lo"), F.max("n_chars").alias("hi"), F.min("source").alias("s"), F.max("source").alias("t")).collect()
    assert sum(r.a <= "fr" <= r.b for r in spans) <= 15
    assert sum(r.lo <= 1000 <= r.hi for r in spans) <= 20
    assert sum(r.s <= "src3" <= r.t for r in spans) <= 20


def test_strings_have_cells_by_whole_values(spark):
    few = spark.createDataFrame([("dataset_a",), ("dataset_b",), ("dataset_z",), (None,)], "source string")
    cells = S.quantised(few.withColumn("n", F.lit(1.0)), ["n"], ["source"])
    assert len({r.source for r in cells(few.withColumn("n", F.lit(1.0))).where("source is not null").collect()}) == 3
    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "https://host/500").otherwise(F.concat(F.lit("https://host/"), (F.col("id") % 997).cast("string"))).alias("source"), F.lit(1.0).alias("n"))
    got = S.quantised(many, ["n"], ["source"])(many.withColumn("v", F.col("source"))).groupBy("source").agg(F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("source").collect()
    assert 16 <= len(got) <= 32 and all(a.hi < b.lo for a, b in zip(got, got[1:]))
    assert sorted(r.c for r in got)[-2] <= 3000 / 32 + 10  # but for the hot one's


def test_write_keeps_repeated_and_null_ids(spark, tmp_path):
    rows = [(i % 7 if i % 3 else None, f"text {i % 50}", f"s{i % 4}", "en", i) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, size int")
    S.write(df, str(tmp_path / "out"), shards=8)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))
    counts = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) <= 300 / 8 + 12
