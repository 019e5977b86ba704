"""Dual-tree rounds against plain ones."""

import hashlib
import math

import numpy as np
import pytest

from corpusmill.llm import centroids as C
from corpusmill.llm.common import table


def brute(rows, k=8, rounds=10, dims=64, scale=1024, seed=3):
    fit = [(i, [max(-C.LIMIT, min(C.LIMIT, math.floor(scale * x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    by = sorted(fit, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    means = [list(v) for _, v in by[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in fit]
        for c in range(len(means)):
            mine = [v for (_, v), o in zip(fit, own) if o == c]
            if mine:
                means[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return sorted(((i, c, d) for i, v in fit for d, c in [near(v)]), key=repr), means


def got(df, **kw):
    rows, means = C.cluster(df, **kw)
    return sorted((tuple(r) for r in rows.select("vec_id", "cluster", "distance").collect()), key=repr), means.tolist()


def test_odd_vectors_ties_and_repeated_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) / 1024 for x in rng.integers(-3, 4, 4)]) for i in range(300)] + [(500, [2.0, 2.0, 2.0, 2.0])] * 120
    rows += [(600, None), (601, [1.0, None, 1.0, 1.0]), (602, [float("nan")] * 4), (603, [float("-inf")] * 4), (604, [1.0] * 3), (605, []), (None, [1.0, 0.0, 0.0, -1.0]), (None, [0.5] * 4), (606, [1e300] * 4), (607, [-1e9] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", C.F.lit("x")).repartition(5)
    assert got(df, dims=4, k=6, rounds=4) == brute(rows, dims=4, k=6, rounds=4)
    assert got(df.where("vec_id < 3"), dims=4) == brute([r for r in rows if r[0] is not None and r[0] < 3], dims=4)
    few, means = C.cluster(df.limit(0), dims=4)
    assert few.collect() == [] and C.described(spark, few, means).collect() == []


def test_equal_first_centroids_leave_the_larger_numbers_empty(spark):
    rows = [(i, [1.0, 2.0]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(df, dims=2, k=4) == brute(rows, dims=2, k=4)


def test_table(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(df, rounds=2) == brute(rows, rounds=2)


@pytest.mark.parametrize("k, spread", [(8, 0.02), (40, 0.3)])
def test_walk_prunes_and_agrees_with_all_pairs(k, spread):
    rng = np.random.default_rng(1)
    heart = rng.normal(size=(12, 16))
    v = C.quantised(heart[rng.integers(0, 12, 3000)] + spread * rng.normal(size=(3000, 16)), 1024)
    v = np.concatenate([v, np.repeat(v[:1], 500, 0)])
    tree = C.Tree(v)
    v = v[tree.order]
    means = v[rng.integers(0, len(v), k)]
    walked = C.assign(tree, v, *C.with_means(means))
    own = np.full(len(v), -1)
    nodes = np.concatenate(walked.nodes)
    n = tree.last[nodes] - tree.first[nodes]
    own[C.ranges(tree.first[nodes], n)] = np.repeat(np.concatenate(walked.node_to), n)
    if walked.rows:
        own[np.concatenate(walked.rows)] = np.concatenate(walked.row_to)
    assert (own == ((v[:, None] - means[None]) ** 2).sum(-1).argmin(1)).all()
    assert walked.compared < 0.5 * len(v) * k


def test_cover_tree_covers_and_separates():
    rng = np.random.default_rng(5)
    v = rng.integers(-500, 500, (1500, 6))
    t = C.Tree(v, leaf=4)
    gap = lambda a, b: np.sqrt(((v[a] - v[b]) ** 2).sum(-1))
    for i in range(len(t.centre)):
        rows = t.order[t.first[i] : t.last[i]]
        assert t.centre[i] in rows and gap(rows, t.centre[i]).max() <= t.radius[i] + 1e-9
        kids = range(t.child[i], t.child[i] + t.children[i])
        if kids:
            assert t.centre[kids[0]] == t.centre[i] and sorted(np.concatenate([t.order[t.first[j] : t.last[j]] for j in kids])) == sorted(rows)
            centres = t.centre[list(kids)]
            apart = gap(centres[:, None], centres[None]) + 1e9 * np.eye(len(centres))
            assert apart.min() > t.radius[i] / C.BASE and t.radius[list(kids)].max() <= t.radius[i] / C.BASE + 1e-9
