"""Keyed stores against a dictionary."""

import random

import pytest
from pyspark.sql import functions as F

from corpusmill.sources.files import ensure_checkpoint_dir
from corpusmill.sources.store import KeyedStore

SCHEMA = "k string, v long, error string"


def opened(spark, tmp_path, **kw):
    ensure_checkpoint_dir(spark)
    return KeyedStore(spark, f"file:{tmp_path}/store", SCHEMA, "k", **({"buckets": 4} | kw))


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_upserts_like_a_dictionary_and_survives_sessions(spark, tmp_path):
    rng, held = random.Random(0), {}
    s = opened(spark, tmp_path)
    assert s.table().collect() == []
    for n in range(4):
        rows = [(f"k{rng.randrange(60)}", n * 100 + i, None) for i in range(40)] + [(None, 1, None)]
        s.upsert(spark.createDataFrame(rows, SCHEMA))
        fresh = {}
        for k, v, _ in rows:
            if k is not None:
                fresh[k] = min(v, fresh.get(k, v))
        held |= fresh
    assert {r.k: r.v for r in s.table().collect()} == held
    s.compact()
    assert {r.k: r.v for r in s.table().collect()} == held and s.versions().count() == len(held)
    spark.sql(f"DROP TABLE {s.name}")  # as a new session, whose catalog knows nothing
    again = opened(spark, tmp_path)
    assert again.generation == 1 and {r.k: r.v for r in again.table().collect()} == held
    again.upsert(spark.createDataFrame([("k0", 7, None)], SCHEMA))
    assert {r.k: r.v for r in again.table().collect()} == held | {"k0": 7}


def test_lookups_never_shuffle_the_store(spark, tmp_path):
    s = opened(spark, tmp_path)
    s.upsert(spark.createDataFrame([(f"k{i}", i, None) for i in range(500)], SCHEMA))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = spark.createDataFrame([(f"k{i}",) for i in range(400, 600)], "k string")
        todo = s.missing(asked)
        assert exchanges(s.table()) == 0 and exchanges(todo) == 1
        assert sorted(r.k for r in todo.collect()) == sorted(f"k{i}" for i in range(500, 600))
        assert exchanges(s.table().join(asked, "k")) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_errors_are_kept_until_they_are_tried_again(spark, tmp_path):
    s, calls = opened(spark, tmp_path), []

    def make(rows, ok=False):
        calls.append(sorted(r.k for r in rows.collect()))
        bad = F.col("k").startswith("bad") & ~F.lit(ok)
        return rows.select("k", F.when(~bad, F.length("k")).cast("long").alias("v"), F.when(bad, F.lit("no")).alias("error"))

    ask = spark.createDataFrame([("a",), ("bad1",), ("a",)], "k string")
    assert {r.k: (r.v, r.error) for r in s.cached(ask.distinct(), make).collect()} == {"a": (1, None), "bad1": (None, "no")}
    s.cached(ask.distinct(), make).collect()
    assert calls == [["a", "bad1"], []]
    assert {r.k: r.v for r in s.cached(ask.distinct(), lambda r: make(r, True), retry="error IS NOT NULL").collect()} == {"a": 1, "bad1": 4}
    assert calls[-1] == ["bad1"]


def test_a_compaction_that_was_cut_off_is_left_out(spark, tmp_path):
    s = opened(spark, tmp_path)
    s.upsert(spark.createDataFrame([("a", 1, None)], SCHEMA))
    (tmp_path / "store/gen=1").mkdir()
    (tmp_path / "store/gen=1/part-0.parquet").write_text("half")
    again = opened(spark, tmp_path)
    assert again.generation == 0 and [r.v for r in again.table().collect()] == [1]
    again.compact()
    assert again.generation == 1 and [r.v for r in again.table().collect()] == [1]


@pytest.mark.parametrize("rows", [[], [(None, None, None)]])
def test_nothing_to_add(spark, tmp_path, rows):
    s = opened(spark, tmp_path)
    s.upsert(spark.createDataFrame(rows, SCHEMA))
    assert s.table().collect() == [] and s.missing(spark.createDataFrame([("x",)], "k string")).count() == 1
