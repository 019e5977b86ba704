"""KD-tree search against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from corpusmill.llm import topk as T
from corpusmill.llm.common import table


def brute(rows, k=5, every=50):
    fit = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in fit:
        if i % every == 0:
            best = sorted(((-sum(a * b for a, b in zip(q, v)), j) for j, v in fit if j != i))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def got(df, **kw):
    return sorted(tuple(r) for r in T.top_k(df, df.where(F.col("vec_id") % 50 == 0), **kw).collect())


def test_table_matches_brute_force(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(df) == brute(rows)
    assert got(df.repartition(6), block=4) == brute(rows)


def test_odd_vectors_ties_and_an_empty_table(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 256]) for i in range(400)]
    rows += [(1000, None), (1050, [1.0, None]), (1100, [float("nan")] * 6), (None, [1.0] * 6), (1150, [float("inf")] * 6), (1200, [2.0, 1.0]), (1250, []), (1300, [3e7] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == []
    assert got(df.where("vec_id in (0, 3)")) == brute([r for r in rows if r[0] in (0, 3)])


def test_bounds_are_tight_and_leaves_are_skipped():
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.integers(-9, 9, (500, 8)) + 40 * np.eye(8, dtype=int)[c] for c in range(8)])
    tree = T.Tree(np.arange(len(v)), v, leaf=50)
    q = v[:20].astype(np.float64)
    for node in range(len(tree.left)):
        if tree.left[node] < 0:
            rows = tree.vectors[tree.first[node] : tree.last[node]]
            assert (tree.bounds(q)[:, node] >= (q @ rows.T).max(1)).all()
            assert (tree.low[node] == rows.min(0)).all() and (tree.high[node] == rows.max(0)).all()
    read = T.search(tree, np.arange(20), v[:20], T.Best(20, 5))
    assert read < 0.8 * 20 * sum(x < 0 for x in tree.left)


def test_repeated_rows_of_a_query_hide_no_neighbour(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-40, 41, 5) / 256]) for i in range(1, 90)] + [(100, [1.0] * 5)] * 9
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    mine = sorted((r.rank, r.vec_id) for r in T.top_k(df, df.where("vec_id = 100")).collect())
    q = np.floor(256 * np.ones(5)).astype(int)
    want = sorted(((-int(q @ np.floor(256 * np.array(v)).astype(int)), i) for i, v in rows if i != 100))[:5]
    assert mine == [(k + 1, i) for k, (_, i) in enumerate(want)]
