"""Lloyd's rounds by two trees: a cover tree over each shard's vectors, and a tree over the centroids each round.

Tasks cut their rows into shards as they come and build each shard's cover tree
once: a node's centre is one of its vectors, its radius reaches all of them,
its children's centres lie farther apart than the radius the children may have,
and its first child has its own centre. Trees are written to the shared folder.
A round walks pairs of a node of vectors and a node of centroids, all pairs of
a level together: a pair whose least possible distance is over the greatest
that the vectors' nearest centroid can have is left out, with room for
rounding. Where one centroid remains, it takes the whole node, whose sum is
known; leaves that still have several are compared exactly, in integers. A task
gives a count and sums for each centroid; these are added up by Spark, so the
driver holds k centroids and nothing else.

Components are floor(scale * x), held to -2^26 and 2^26, so squared distances
fit a long. Vectors that are null, hold a null or non-finite component or have
another number of components take no part. Equal distances go to the smaller
number. Rows that repeat a vec_id count each. The first centroids are the kept
rows with the least SHA-256 of `seed:vec_id`, ties by vector; rows without a
vec_id come last. With fewer kept rows than k there are so many centroids.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, frugal

SHARD, LEAF, LIMIT = 4096, 32, 1 << 26
#: A child's radius is at most its parent's over this.
BASE = 1.3
#: Pairs of a vector and a centroid that are compared at once.
BLOCK = 1 << 14
#: Room for rounding in bounds.
SLACK = 1e-9


class Tree:
    """A cover tree. Node i has rows first[i]..last[i] of `order` and children child[i]..child[i] + children[i]."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF, base: float = BASE):
        v = vectors.astype(np.float64)
        self.order = np.arange(len(v))
        centre, radius, first, last, child, children = [0], [0.0], [0], [len(v)], [], []
        at = 0
        while at < len(centre):  # breadth first, so that children stand together
            a, z = first[at], last[at]
            rows = self.order[a:z]
            far = np.sqrt(((v[rows] - v[centre[at]]) ** 2).sum(1))
            radius[at] = float(far.max())
            child.append(len(centre))
            if z - a > leaf and radius[at] > 0:
                cover, parts, mid = radius[at] / base, [], centre[at]
                while len(rows):
                    inside = far <= cover
                    parts.append((mid, rows[inside]))
                    rows = rows[~inside]
                    if len(rows):
                        mid = int(rows[0])
                        far = np.sqrt(((v[rows] - v[mid]) ** 2).sum(1))
                self.order[a:z] = np.concatenate([p for _, p in parts])
                for mid, p in parts:
                    centre.append(mid)
                    radius.append(0.0)
                    first.append(a)
                    a += len(p)
                    last.append(a)
            children.append(len(centre) - child[at])
            at += 1
        self.centre, self.radius = np.array(centre), np.array(radius)
        self.first, self.last, self.child, self.children = (np.array(x) for x in (first, last, child, children))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... of each range, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Assigned:
    """What a walk found: nodes that go to a centroid whole, and rows (places in the tree's order) with theirs."""

    def __init__(self) -> None:
        self.nodes, self.node_to, self.rows, self.row_to, self.compared = [], [], [], [], 0


def nearest(vectors: np.ndarray, rows: np.ndarray, many: np.ndarray, cands: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """For each row its nearest candidate; row i has the next many[i] of cands, in rising order."""
    out, ends = np.empty(len(rows), np.int64), np.cumsum(many)
    lo = 0
    while lo < len(rows):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BLOCK, side="right")))
        m = many[lo:hi]
        starts = np.cumsum(m) - m
        c = cands[ends[lo] - many[lo] : ends[hi - 1]]
        gap = vectors[np.repeat(rows[lo:hi], m)] - centroids[c]
        d = np.einsum("ij,ij->i", gap, gap)
        least = np.repeat(np.minimum.reduceat(d, starts), m)
        out[lo:hi] = np.minimum.reduceat(np.where(d == least, c, len(centroids)), starts)
        lo = hi
    return out


def assign(tree: Tree, vectors: np.ndarray, centroids: np.ndarray, means: Tree, distinct: np.ndarray) -> Assigned:
    """The walk. vectors in the tree's order; means: a tree over centroids[distinct], which no two share."""
    v, c = vectors.astype(np.float64), centroids[distinct].astype(np.float64)
    back = np.empty(len(tree.order), np.int64)
    back[tree.order] = np.arange(len(tree.order))
    at_v, at_c = v[back[tree.centre]], c[means.centre]
    out = Assigned()
    pv, pc = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(pv):
        starts = np.flatnonzero(np.r_[True, pv[1:] != pv[:-1]])
        sizes = np.diff(np.r_[starts, len(pv)])
        d, rv, rc = np.sqrt(((at_v[pv] - at_c[pc]) ** 2).sum(1)), tree.radius[pv], means.radius[pc]
        reach = np.repeat(np.minimum.reduceat(d, starts), sizes) + rv  # a node's centre is a centroid
        keep = d - rv - rc <= reach + SLACK * (1 + d + rv + rc)
        pv, pc = pv[keep], pc[keep]
        starts = np.flatnonzero(np.r_[True, pv[1:] != pv[:-1]])
        sizes, nodes = np.diff(np.r_[starts, len(pv)]), pv[starts]
        parted, leaf = means.children[pc] > 0, tree.children[nodes] == 0
        wide = np.maximum.reduceat(np.where(parted, means.radius[pc], -1.0), starts)
        split_c = (wide >= 0) & (leaf | (wide >= tree.radius[nodes]))
        whole, exact = ~split_c & (sizes == 1) & (wide < 0), ~split_c & (sizes > 1) & leaf
        out.nodes.append(nodes[whole])
        out.node_to.append(distinct[means.order[means.first[pc[starts[whole]]]]])
        if exact.any():
            mine = np.repeat(exact, sizes)
            cands = distinct[means.order[means.first[pc[mine]]]]
            number = np.sort(np.repeat(np.arange(exact.sum()), sizes[exact]) * len(centroids) + cands) % len(centroids)
            n, m = tree.last[nodes[exact]] - tree.first[nodes[exact]], sizes[exact]
            rows, many = ranges(tree.first[nodes[exact]], n), np.repeat(m, n)
            which = ranges(np.repeat(np.cumsum(m) - m, n), many)
            out.rows.append(rows)
            out.row_to.append(nearest(vectors, rows, many, number[which], centroids))
            out.compared += len(which)
        on = ~whole & ~exact
        by_c, by_v = np.repeat(on & split_c, sizes), np.repeat(on & ~split_c, sizes)
        k = np.where(means.children[pc] > 0, means.children[pc], 1)[by_c]
        nv, nc = [np.repeat(pv[by_c], k)], [ranges(np.where(means.children[pc] > 0, means.child[pc], pc)[by_c], k)]
        k = tree.children[pv[by_v]]
        nv.append(ranges(tree.child[pv[by_v]], k))
        nc.append(np.repeat(pc[by_v], k))
        pv, pc = np.concatenate(nv), np.concatenate(nc)
        order = np.argsort(pv, kind="stable")
        pv, pc = pv[order], pc[order]
    return out


def fitting(vectors: DataFrame, dims: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): the rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where((F.size(v) == dims) & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))


def quantised(values: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), -LIMIT, LIMIT).astype(np.int64)


def shards(rows: DataFrame, dims: int, scale: int, size: int = SHARD, leaf: int = LEAF) -> DataFrame:
    """A row for each shard: its tree, vectors and ids, the latter two in the tree's order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        held, n = [], 0

        def built() -> Iterator[pa.RecordBatch]:
            ids, v = (np.concatenate(x) for x in zip(*held))
            for a in range(0, len(v), size):
                part = v[a : a + size]
                tree = Tree(part, leaf)
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((tree, part[tree.order].astype(np.int32), ids[a : a + size][tree.order]))], pa.binary())], names=["shard"])

        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            held.append((np.array(batch.column(0).to_pylist(), object), quantised(flat.reshape(-1, dims), scale)))
            n += batch.num_rows
            if n >= 4 * size:
                yield from built()
                held, n = [], 0
        if n:
            yield from built()

    return rows.mapInArrow(run, "shard binary")


def with_means(centroids: np.ndarray) -> tuple[np.ndarray, Tree, np.ndarray]:
    """Centroids, a tree over the distinct ones with one in each leaf, and their numbers; of equal ones the least."""
    _, least = np.unique(centroids, axis=0, return_index=True)
    distinct = np.sort(least)
    return centroids, Tree(centroids[distinct], leaf=1), distinct


def sums(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, dim, total): a shard's sums by centroid and component; dim -1 is the count."""
    held = found.sparkSession.sparkContext.broadcast(with_means(centroids))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        k, dims = held.value[0].shape
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            for raw in batch.column(0):
                tree, v, _ = pickle.loads(raw.as_py())
                v = v.astype(np.int64)
                got = assign(tree, v, *held.value)
                run_up = np.concatenate([np.zeros((1, dims), np.int64), np.cumsum(v, 0)])
                nodes, to = np.concatenate(got.nodes), np.concatenate(got.node_to)
                a, z = tree.first[nodes], tree.last[nodes]
                np.add.at(total, to, np.c_[z - a, run_up[z] - run_up[a]])
                if got.rows:
                    rows, to = np.concatenate(got.rows), np.concatenate(got.row_to)
                    np.add.at(total, to, np.c_[np.ones(len(rows), np.int64), v[rows]])
        used = np.repeat(np.flatnonzero(total[:, 0]), dims + 1)
        if len(used):
            dim = np.tile(np.arange(-1, dims), len(used) // (dims + 1))
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(dim, pa.int32()), pa.array(total[used, dim + 1])], names=["cluster", "dim", "total"])

    return found.mapInArrow(run, "cluster int, dim int, total long")


def moved(found: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the floor of its vectors' mean; one without vectors stays. What is collected has k * (dims + 1) rows."""
    out, by = centroids.copy(), {}
    for r in sums(found, centroids).groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        by[r.cluster, r.dim] = int(r.total)
    for (c, dim), total in by.items():
        if dim >= 0:
            out[c, dim] = total // by[c, -1]
    return out


def members(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector; distances are squared."""
    held = found.sparkSession.sparkContext.broadcast(with_means(centroids))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            for raw in batch.column(0):
                tree, v, ids = pickle.loads(raw.as_py())
                v = v.astype(np.int64)
                got, own = assign(tree, v, *held.value), np.empty(len(ids), np.int64)
                nodes = np.concatenate(got.nodes)
                n = tree.last[nodes] - tree.first[nodes]
                own[ranges(tree.first[nodes], n)] = np.repeat(np.concatenate(got.node_to), n)
                if got.rows:
                    own[np.concatenate(got.rows)] = np.concatenate(got.row_to)
                gap = v - held.value[0][own]
                yield pa.RecordBatch.from_arrays([pa.array(ids.tolist(), pa.int64()), pa.array(own, pa.int32()), pa.array(np.einsum("ij,ij->i", gap, gap))], names=["vec_id", "cluster", "distance"])

    return found.mapInArrow(run, "vec_id long, cluster int, distance long")


def seeds(rows: DataFrame, k: int, dims: int, seed: int, scale: int) -> np.ndarray:
    """The first centroids."""
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.withColumn("h", by).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).select("v").collect()
    return quantised(np.array([r.v for r in first], np.float64).reshape(len(first), dims), scale)


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance), centroids) after so many rounds and a last assignment."""
    rows = fitting(vectors, dims, id_col, vector_col)
    centroids = seeds(rows, k, dims, seed, scale)
    if not len(centroids):
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), centroids
    found = cut(shards(rows, dims, scale))
    for _ in range(rounds):
        centroids = moved(found, centroids)
    return members(found, centroids), centroids


def described(spark: SparkSession, rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """members with each cluster's and the whole inertia and the SHA-256 of its centroid. There are k clusters."""
    rows = cut(rows)
    by = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(by.values())
    known = [(c, s, total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in by.items()]
    table = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
