"""Near copies by the Jaccard similarity of their five-word shingles.

Words are those of SimHash (lower-cased, A-Z only); a text of fewer words is one shingle. Texts of the same words are
one node. Candidates share one of 25 bands of four MinHash values: a pair of similarity 0.8 shares none once in
500,000, a closer one more seldom. Each candidate is checked exactly, on the sets of shingles themselves.

Nodes are settled in order of id: one stays unless it is similar to an earlier one that stays. Candidates fall into
clusters, the components of shared bands; a cluster of up to LARGE nodes and LARGE * SHINGLES shingles is settled in one
task, from one copy of its sets. Larger ones are cut into blocks by id, and blocks are settled in turn: one task settles
a block, and what stays of it is held against each later block in a task of its own. So there are as many rounds as
blocks, however few nodes a cluster loses. Nodes are only compared where their rarest shingles meet: of two sets of
similarity 0.8, the rarest fifth of each, and one shingle more, share one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, over_batches, sole
from .simhash import STRIDE, shingle_hashes, stars

WIDTH, BANDS, ROWS = 5, 25, 4
#: Nodes of the largest cluster that one task settles, and the mean of their shingles.
LARGE, SHINGLES = 5000, 1000
#: Sets that are compared with one at once.
SOME = 256


def _words(texts: list[str | None]) -> list[list[bytes]]:
    return [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]


def _digests(words: list[list[bytes]]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(b" ".join(w)) for w in words], np.uint64).view(np.int64)


def _runs(words: list[list[bytes]]):
    """Indices of texts with words, about STRIDE words at a time."""
    some, n = [], 0
    for i, w in enumerate(words):
        if w:
            if some and n + len(w) > STRIDE:
                yield some
                some, n = [], 0
            some.append(i)
            n += len(w)
    if some:
        yield some


def bands(words: list[list[bytes]], width: int = WIDTH) -> pa.Array:
    """Keys of each text's bands; none for a text without words."""
    rng = np.random.default_rng(5)
    a, b = (rng.integers(0, 2**64, BANDS * ROWS, np.uint64) | np.uint64(1) for _ in range(2))
    mix = rng.integers(0, 2**64, (BANDS, ROWS), np.uint64) | np.uint64(1)
    full = np.fromiter((bool(w) for w in words), bool, len(words))
    out = np.empty((len(words), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for some in _runs(words):
            h, _, first = shingle_hashes([words[i] for i in some], width)
            least = np.stack([np.minimum.reduceat((h ^ (h >> np.uint64(31))) * x + y, first[:-1]) for x, y in zip(a, b)], 1)
            least ^= least >> np.uint64(29)
            out[some] = (least.reshape(-1, BANDS, ROWS) * mix).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
    offs = np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(out[full].ravel().view(np.int64)))


def sets(words: list[list[bytes]], width: int = WIDTH) -> pa.Array:
    """The distinct shingles of each text, hashed."""
    made = [np.zeros(0, np.int64)] * len(words)
    for some in _runs(words):
        h, _, first = shingle_hashes([words[i] for i in some], width)
        for i, lo, hi in zip(some, first[:-1], first[1:]):
            made[i] = np.unique(h[lo:hi]).view(np.int64)
    return pa.array(made, pa.list_(pa.int64()))


def _hashed(docs: DataFrame, name: str, make) -> DataFrame:
    def run(cols, n):
        sole("resemble", lambda: None)
        words = _words(cols["text"].to_pylist())
        return {"doc_id": cols["doc_id"], "d": _digests(words), name: make(words)}

    return over_batches(docs.select("doc_id", "text"), run, pa.schema([("doc_id", pa.int64()), ("d", pa.int64()), (name, pa.list_(pa.int64()))]), f"doc_id long, d long, {name} array<long>")


def _shared(keys: DataFrame) -> DataFrame:
    """Keys that two rows or more hold."""
    return keys.join(keys.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("k"), "k", "left_semi")


def _similar(sets: list[pa.ChunkedArray], known: int, grow: bool) -> np.ndarray:
    """Of sets (not empty) in order: which are similar to an earlier one that stays. The first `known` stay; later ones only count for others if grow."""
    flat = np.concatenate([s.combine_chunks().flatten().to_numpy() for s in sets])
    sizes = np.concatenate([s.combine_chunks().value_lengths().to_numpy() for s in sets]).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    _, at, counts = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))  # rarest first
    at, lone = rank[at], int((counts == 1).sum())
    mark, gone = np.zeros(len(counts), bool), np.zeros(len(sizes), bool)
    held: dict[int, list[int]] = {}
    for i, (lo, n) in enumerate(zip(starts, sizes)):
        mine = np.sort(at[lo : lo + n])
        rare = mine[: n - (4 * n + 4) // 5 + 1]
        rare = rare[rare >= lone].tolist()
        if i >= known:
            near = np.array(sorted({j for t in rare for j in held.get(t, ())}), np.int64)
            near = near[5 * np.minimum(sizes[near], n) >= 4 * np.maximum(sizes[near], n)]
            mark[mine] = True
            for k in range(0, len(near), SOME):
                some = near[k : k + SOME]
                ends = np.cumsum(sizes[some])
                first = ends - sizes[some]
                common = np.add.reduceat(mark[at[np.arange(ends[-1]) + np.repeat(starts[some] - first, sizes[some])]], first, dtype=np.int64)
                if (5 * common >= 4 * (sizes[some] + n - common)).any():
                    gone[i] = True
                    break
            mark[mine] = False
        if i < known or (grow and not gone[i]):
            for t in rare:
                held.setdefault(t, []).append(i)
    return gone


def _settle(cluster: pa.Table) -> pa.Table:
    """The nodes of a cluster that go."""
    cluster = cluster.sort_by([("doc_id", "ascending"), ("d", "ascending")])
    return cluster.select(["d"]).filter(pa.array(_similar([cluster["s"]], 0, True)))


def _beaten(stay: pa.Table, later: pa.Table) -> pa.Table:
    """The later nodes that are similar to one of those that stay."""
    if not stay.num_rows or not later.num_rows:
        return later.select(["d"]).slice(0, 0)
    return later.select(["d"]).filter(pa.array(_similar([stay["t"], later["s"]], stay.num_rows, False)[stay.num_rows :]))


def kept(docs: DataFrame, among: DataFrame | None = None, large: int = LARGE) -> DataFrame:
    """(doc_id, n): ids of (doc_id long, never null; text) that stay, and how many rows that would stay have that id.

    among: the ids (doc_id, distinct) that count at all, if not every one does.
    """
    hashed = _hashed(docs, "band", bands)
    if among is not None:
        hashed = hashed.join(among, "doc_id", "left_semi")
    each = hashed.groupBy("d", "doc_id").agg(F.count("*").alias("n"), F.first("band").alias("band"))
    nodes = cut(each.groupBy("d").agg(F.min(F.struct("doc_id", "n")).alias("m"), F.first("band").alias("band")).select("d", "m.doc_id", "m.n", "band"))
    keys = cut(_shared(nodes.select(F.explode("band").alias("k"), F.struct("doc_id", "d").alias("o"))))
    ids = keys.select("o.doc_id", "o.d").distinct()
    star = stars(keys.join(keys.groupBy("k").agg(F.min("o.d").alias("a")), "k").select("a", F.col("o.d").alias("b")).distinct())
    ids = cut(ids.join(star.withColumnRenamed("node", "d"), "d", "left").select("doc_id", "d", F.coalesce("root", "d").alias("root")))
    texts = docs.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")
    held = cut(_hashed(texts, "s", sets).join(ids, ["doc_id", "d"]).groupBy("doc_id", "d", "root").agg(F.first("s").alias("s")))
    blocks = F.ceil(F.greatest(F.count("*") / large, F.sum(F.size("s")) / (large * SHINGLES)))
    big = cut(held.groupBy("root").agg(blocks.alias("n")).where(F.col("n") > 1).select("root", "n"))
    gone = cut(held.join(big, "root", "left_anti").groupBy("root").applyInArrow(_settle, "d long"))
    if most := big.agg(F.max("n")).first()[0]:
        gone = gone.unionByName(_rounds(held.join(big.select("root"), "root"), most))
    return nodes.join(gone, "d", "left_anti").groupBy("doc_id").agg(F.sum("n").alias("n"))


def _rounds(held: DataFrame, n: int) -> DataFrame:
    """The nodes (d) that go of clusters (doc_id, d, root, s), settled in n blocks by id."""
    bounds = cut(held.groupBy("root").agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], max(10000, 20 * n)).alias("bounds")))
    nodes = cut(held.join(bounds, "root").select("doc_id", "d", "root", "s", F.size(F.filter("bounds", lambda b: b < F.col("doc_id"))).alias("block")))
    gone = None
    for block in range(n):
        now, later = nodes.where(F.col("block") == block), nodes.where(F.col("block") > block)
        went = (now if gone is None else now.join(gone, "d", "left_anti")).groupBy("root").applyInArrow(_settle, "d long")
        gone = cut(went if gone is None else gone.unionByName(went))
        if block + 1 < n:
            stay = now.join(gone, "d", "left_anti").select(F.col("root").alias("r"), F.col("s").alias("t"), F.explode(F.sequence(F.lit(block + 1), F.lit(n - 1))).alias("b"))
            later = later.join(gone, "d", "left_anti")
            gone = cut(gone.unionByName(stay.groupBy("r", "b").cogroup(later.groupBy("root", "block")).applyInArrow(_beaten, "d long")))
    return gone
