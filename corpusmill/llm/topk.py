"""Exact top-k by inner product: a KD-tree per shard, searched best first.

Vectors are quantised to integers, floor(256 x), so scores are exact. Each task
cuts its rows into shards as they come (no shuffle, so no hot shard) and builds
a KD-tree over each: median splits on the widest dimension down to small leaves,
each node with the tight box of its rows. The product of a query with anything
in a box is at most the sum over dimensions of the greater of q*low and q*high;
a node whose bound is below the k-th score so far can't help. A task carries each query's k-th score
from shard to shard, and a first pass over a few shards gives all tasks a start.

The queries go out in blocks of bounded size, each block a broadcast that meets
every shard once.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SHARD, LEAF, BLOCK, SCALE = 4096, 96, 4096, 256
#: Shards in the first pass, of about this many in a block's search.
SEED_SHARE = 16
LIMIT = 2**62


def quantise(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their integer vectors, padded with zeros to the widest)."""
    keep, rows = [], []
    flat = lists.flatten().cast(pa.float64())
    sizes = np.array([-1 if n is None else n for n in lists.value_lengths().to_pylist()], np.int64)
    values = flat.to_numpy(zero_copy_only=False)  # nulls become NaN
    ends = np.cumsum(np.maximum(sizes, 0))
    for i, (n, e) in enumerate(zip(sizes.tolist(), ends.tolist())):
        if n >= 0:
            v = values[e - n : e]
            if np.isfinite(v).all():
                keep.append(i)
                rows.append(v)
    width = max((len(v) for v in rows), default=0)
    out = np.zeros((len(rows), width))
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return np.array(keep, np.int64), np.clip(np.floor(out * SCALE), -LIMIT, LIMIT).astype(np.int64)


class Tree:
    """Nodes in preorder. left[i] < 0: a leaf over rows first[i]..last[i] of ids and vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.low, self.high, self.left, self.right, self.first, self.last = [], [], [], [], [], []
        order = np.arange(len(ids))
        self._grow(vectors, order, 0, len(ids), leaf)
        self.ids, self.vectors = ids[order], vectors[order]
        self.low, self.high = np.stack(self.low), np.stack(self.high)

    def _grow(self, v: np.ndarray, order: np.ndarray, a: int, b: int, leaf: int) -> int:
        me = len(self.left)
        rows = v[order[a:b]]
        lo, hi = rows.min(0), rows.max(0)
        for x, y in ((self.low, lo), (self.high, hi), (self.left, -1), (self.right, -1), (self.first, a), (self.last, b)):
            x.append(y)
        if b - a > leaf and (hi > lo).any():
            d = int((hi - lo).argmax())
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(rows[:, d], mid)]
            self.left[me] = self._grow(v, order, a, a + mid, leaf)
            self.right[me] = self._grow(v, order, a + mid, b, leaf)
        return me

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """[query, node]: the greatest product that a row of the node can have."""
        pos, neg = np.maximum(queries, 0), np.minimum(queries, 0)
        return pos @ self.high.T.astype(queries.dtype) + neg @ self.low.T.astype(queries.dtype)


def exact_type(*arrays: np.ndarray) -> type:
    """float64 where all sums of products are exact in it, Python integers elsewhere."""
    top = [float(np.abs(a.astype(np.float64)).max()) if a.size else 0.0 for a in arrays]
    return np.float64 if top[0] * top[1] * max(a.shape[1] for a in arrays) < 2**52 else object


def widen(v: np.ndarray, width: int) -> np.ndarray:
    return v if v.shape[1] == width else np.pad(v, ((0, 0), (0, width - v.shape[1])))


class Best:
    """The k best (score, -vec_id) of each query, and from outside a score below which nothing counts."""

    def __init__(self, n: int, k: int, floor: list | None = None):
        self.heaps, self.k, self.floor = [[] for _ in range(n)], k, floor or [None] * n

    def bar(self, q: int):
        h = self.heaps[q]
        own = h[0][0] if len(h) == self.k else None
        out = self.floor[q]
        return own if out is None or (own is not None and own > out) else out

    def offer(self, q: int, score: int, vec_id: int) -> None:
        h, item = self.heaps[q], (score, -vec_id)
        if len(h) < self.k:
            heapq.heappush(h, item)
        elif item > h[0]:
            heapq.heapreplace(h, item)


def search(tree: Tree, ids: np.ndarray, queries: np.ndarray, best: Best) -> int:
    """Best-first traversal for every query; returns how many leaves were read."""
    width = max(tree.vectors.shape[1], queries.shape[1])
    kind = exact_type(queries, tree.vectors)
    q, v = widen(queries, width).astype(kind), widen(tree.vectors, width).astype(kind)
    if tree.low.shape[1] < width:
        tree.low, tree.high = widen(tree.low, width), widen(tree.high, width)
    bounds, leaves = tree.bounds(q), 0
    for i in range(len(q)):
        b, own = bounds[i], int(ids[i])
        todo = [(-b[0], 0)]
        while todo:
            bound, node = heapq.heappop(todo)
            bar = best.bar(i)
            if bar is not None and -bound < bar:
                break
            if tree.left[node] >= 0:
                for child in (tree.left[node], tree.right[node]):
                    if bar is None or b[child] >= bar:
                        heapq.heappush(todo, (-b[child], child))
                continue
            leaves += 1
            a, z = tree.first[node], tree.last[node]
            scores, their = v[a:z] @ q[i], tree.ids[a:z]
            if (their == own).any():  # before the greatest are taken: a repeated row has its own id more than once
                scores, their = scores[their != own], their[their != own]
            if bar is not None:
                some = np.flatnonzero(scores >= bar)
            elif len(scores) > 4 * best.k and kind is np.float64:
                some = np.flatnonzero(scores >= np.partition(scores, -best.k)[-best.k])
            else:
                some = np.arange(len(scores))
            for j in some.tolist():
                best.offer(i, int(scores[j]), int(their[j]))
    return leaves


def shards(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = SHARD) -> DataFrame:
    """One row per shard: no (a number), tree (pickled). Rows with a null id or an unfit vector take no part."""
    df = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())

    def run(batches):
        held_ids, held, n = [], [], 0

        def built():
            width = max(v.shape[1] for v in held)
            ids, v = np.concatenate(held_ids), np.concatenate([widen(v, width) for v in held])
            for a in range(0, len(ids), size):
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Tree(ids[a : a + size], v[a : a + size]))], pa.binary())], names=["tree"])

        for batch in batches:
            keep, v = quantise(batch.column(1))
            if len(keep):
                held_ids.append(batch.column(0).to_numpy()[keep])
                held.append(v)
                n += len(keep)
            if n >= 4 * size:
                yield from built()
                held_ids, held, n = [], [], 0
        if n:
            yield from built()

    return df.mapInArrow(run, "tree binary").withColumn("no", F.monotonically_increasing_id())


def scan(found: DataFrame, block: tuple[np.ndarray, np.ndarray], k: int, floor: list | None) -> DataFrame:
    """(q, vec_id, score): for each task the k best of each query of a block that reach its floor."""
    held = found.sparkSession.sparkContext.broadcast((block, floor))

    def run(batches):
        (ids, queries), floor = held.value
        best = Best(len(ids), k, floor)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                search(pickle.loads(raw), ids, queries, best)
        rows = [(q, -i, s) for q, h in enumerate(best.heaps) for s, i in h]
        if rows:
            q, i, s = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array([max(-(2**63), min(2**63 - 1, x)) for x in s], pa.int64())], names=["q", "vec_id", "score"])

    return found.select("tree").mapInArrow(run, "q long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k greatest integer products, ties to the smaller vec_id.

    A query's own id is no candidate. Vectors that are null or hold a null or non-finite component, and rows without
    an id, take no part. Repeated query rows count once. Shorter vectors count as padded with zeros.
    """
    spark = vectors.sparkSession
    found = cut(shards(vectors, id_col, vector_col))
    mine = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull()).distinct()
    n, total = mine.count(), found.count()
    parts = max(1, -(-n // block))
    number = mine.withColumn("b", F.pmod(F.xxhash64("id", "v"), F.lit(parts)))
    out = None
    for b in range(parts):  # the stated queries meet all rows block by block
        rows = number.where(F.col("b") == b).orderBy("id").select("id", "v").toArrow().combine_chunks()
        keep, v = quantise(rows.column("v").combine_chunks()) if rows.num_rows else (np.empty(0, np.int64), None)
        if not len(keep):
            continue
        ids = rows.column("id").to_numpy()[keep]
        floor = [None] * len(ids)
        if total > 1:
            first = found.where(F.pmod(F.xxhash64("no"), F.lit(SEED_SHARE)) == 0) if total >= 4 * SEED_SHARE else found.orderBy("no").limit(1)
            w = Window.partitionBy("q").orderBy(F.desc("score"))
            for r in scan(first, (ids, v), k, None).withColumn("r", F.row_number().over(w)).where(F.col("r") == k).select("q", "score").collect():
                floor[r.q] = r.score  # one number a query of the block
        best = scan(found, (ids, v), k, floor)
        names = spark.createDataFrame(pa.table({"q": pa.array(range(len(ids)), pa.int64()), "query_id": pa.array(ids, pa.int64())}))
        w = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        got = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).join(F.broadcast(names), "q").select("query_id", "rank", "vec_id", "score")
        out = got if out is None else out.unionByName(got)
    return out if out is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
