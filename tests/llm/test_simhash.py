"""SimHash against word-by-word and all-pairs versions."""

import random

import numpy as np
import xxhash

from corpusmill.llm import simhash
from corpusmill.llm.common import table


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), seed=42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps):
    """{fp: set of linked fps} by comparing all pairs."""
    distinct = list(dict.fromkeys(fps))
    parent = {f: f for f in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    arr = np.array(distinct, np.uint64)
    for f in distinct:
        for g in arr[np.bitwise_count(arr ^ np.uint64(f)) <= 2]:
            parent[find(int(g))] = find(f)
    return {f: find(f) for f in distinct}


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    root = plain_components(fps)
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(((i, f, least.get(root[f])) for (i, _), f in zip(rows, fps)), key=str)


def got(df):
    return sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in df.collect()), key=str)


def test_fingerprints_of_odd_texts():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "one TWO", "a b c", "É é x", "w" * 700 + " " + "v" * 40 + " end", "\x0b\x0ca\rb c d"]
    texts += [" ".join("".join(rng.choices("abcdefghijé", k=rng.randint(1, 19))) for _ in range(rng.randint(1, 200))) for _ in range(50)]
    assert [int(x) for x in simhash.fingerprints(texts)] == [plain_fingerprint(t) for t in texts]


def test_components_match_all_pairs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(simhash.near_duplicates(docs)) == expected(rows)


def test_links_in_crowded_and_sparse_regions(spark):
    rng = random.Random(2)
    fps = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 60])):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            fps.add(x)
    for dear, m in ((0.0, 3), (8.0, 3), (70.0, 3), (1e18, 3), (20.0, 2), (1e18, 2)):
        nodes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
        edges = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in simhash.links(nodes, dear=dear, m=m).collect()]
        assert all(bin(a ^ b).count("1") <= 2 for a, b in edges)
        parent = {f: f for f in fps}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            parent[find(a)] = find(b)
        root = plain_components(fps)
        assert len({find(f) for f in fps}) == len(set(root.values()))
        assert len({(find(f), root[f]) for f in fps}) == len(set(root.values()))


def test_nulls_repeats_empty_table_and_clashing_names(spark):
    rows = [(1, None), (2, ""), (None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "lonely words stand here")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp int, component_id string")
    assert got(simhash.near_duplicates(df)) == expected(rows)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_allocation_spends_the_radius():
    cost = np.random.default_rng(0).uniform(1, 9, (4, 3, 50)).cumsum(1)
    t, w = simhash.allocate(cost, 2)
    assert (t.sum(0) == 2 - 4 + 1).all() and t.min() >= -1
    paid = sum(np.where(t[i] >= 0, cost[i][np.maximum(t[i], 0), np.arange(50)], 0) for i in range(4))
    assert np.allclose(paid, w)


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)]
    roots = {r.node: r.root for r in simhash.stars(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert roots == {i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 400)}
