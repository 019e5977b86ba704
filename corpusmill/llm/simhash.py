"""SimHash fingerprints, and near-duplicate components by the generalised pigeonhole principle.

Fingerprint: words of the lower-cased text (A-Z only), 3-word shingles with
repeats, XXH64 with seed 42; a bit is 1 if it is set in over half the hashes.

Linking within a Hamming radius r: the 64 bits are grouped into m partitions so
that correlated bits stay together; each fingerprint gets thresholds t_1..t_m
with sum r - m + 1 from a dynamic programme over estimated candidate counts, and
probes the index of partition i with every value within t_i of its own (-1: it
does not probe there). Two fingerprints within r must agree within t_i in some
partition, so no link is lost. There are three partitions, and two of 32 bits
from MANY fingerprints on, so that buckets stay small as the corpus grows.

A fingerprint takes the exact way for crowded regions instead where every
allocation is too dear by the estimate, where it lies in a bucket that really
holds more than DEAR fingerprints, or where it would probe such a bucket: it
posts its 65 one-bit neighbours as keys. Two fingerprints within 2 bits share
such a key, and those that share one are within 2 bits, so every key links its
holders to the least of them: 65 rows for a fingerprint, never pairs within a
group. Buckets that hold more are never joined.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, over_batches, sole, tidy

P1, P2, P3, P4, P5 = (np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
SEED, BITS, STRIDE = 42, 64, 200_000
#: Estimated work of the cheapest allocation (probes and candidates), and true size of a bucket, above which neighbour keys are posted.
DEAR = 256.0
#: Distinct fingerprints from which two partitions are cheaper than three: 3 * 2^-21 candidates each then exceed 34 probes.
MANY = 1 << 24


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64_equal(buf: np.ndarray, starts: np.ndarray, length: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of equally long slices of buf; buf has 8 spare bytes at its end."""
    words = np.ndarray((len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))
    halves = np.ndarray((len(buf) - 3,), dtype="<u4", buffer=buf, strides=(1,))
    at, left, s = starts.copy(), length, np.uint64(seed)
    with np.errstate(over="ignore"):
        if length >= 32:
            v = [np.full(len(at), x, np.uint64) for x in (s + P1 + P2, s + P2, s, s - P1)]
            while left >= 32:
                for i in range(4):
                    v[i] = _rotl(v[i] + words[at + 8 * i] * P2, 31) * P1
                at, left = at + 32, left - 32
            h = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
            for x in v:
                h = (h ^ (_rotl(x * P2, 31) * P1)) * P1 + P4
        else:
            h = np.full(len(at), s + P5, np.uint64)
        h = h + np.uint64(length)
        while left >= 8:
            h = _rotl(h ^ (_rotl(words[at] * P2, 31) * P1), 27) * P1 + P4
            at, left = at + 8, left - 8
        if left >= 4:
            h = _rotl(h ^ (halves[at].astype(np.uint64) * P1), 23) * P2 + P3
            at, left = at + 4, left - 4
        while left:
            h = _rotl(h ^ (buf[at].astype(np.uint64) * P5), 11) * P1
            at, left = at + 1, left - 1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def _hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    out = np.empty(len(starts), np.uint64)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for some in np.split(order, cuts):
        n = int(lengths[some[0]])
        if n <= 512 and len(some) > 8:
            out[some] = xxh64_equal(buf, starts[some], n)
        else:
            for i in some:
                out[i] = xxhash.xxh64_intdigest(buf[starts[i] : ends[i]].tobytes(), seed=SEED)
    return out


def fingerprints(texts: list[str | None], width: int = 3) -> np.ndarray:
    """The SimHash of each text; null and empty texts get 0."""
    out = np.zeros(len(texts), np.uint64)
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    full = [i for i, w in enumerate(words) if w]
    lo = 0
    while lo < len(full):
        hi, n = lo, 0
        while hi < len(full) and (hi == lo or n + len(words[full[hi]]) <= STRIDE):
            n, hi = n + len(words[full[hi]]), hi + 1
        some = full[lo:hi]
        out[some] = _block([words[i] for i in some], width)
        lo = hi
    return out


def shingle_hashes(docs: list[list[bytes]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """XXH64 of the shingles of texts with words, one text after another; how many each has; where each begins, and the end."""
    counts = np.array([len(d) for d in docs], np.int64)
    flat = list(itertools.chain.from_iterable(docs))
    raw = b" ".join(flat)
    buf = np.frombuffer(raw + b"\0" * 8, np.uint8)
    lengths = np.fromiter(map(len, flat), np.int64, len(flat))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    offs = np.concatenate([[0], np.cumsum(counts)])
    made = np.maximum(counts - width + 1, 1)
    first = np.concatenate([[0], np.cumsum(made)])
    inner = np.arange(first[-1]) - np.repeat(first[:-1], made)
    at = np.repeat(offs[:-1], made) + inner
    last = at + np.repeat(np.minimum(counts, width), made) - 1
    return _hashes(buf, starts[at], ends[last]), made, first


def _block(docs: list[list[bytes]], width: int) -> np.ndarray:
    h, made, first = shingle_hashes(docs, width)
    ones = np.empty((len(docs), BITS), np.int64)
    step = 1 << 16
    ones[:] = 0
    for a in range(0, len(h), step):
        part = np.unpackbits(h[a : a + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        d0 = int(np.searchsorted(first, a, side="right")) - 1
        d1 = int(np.searchsorted(first, a + len(part), side="left"))
        cuts = np.maximum(first[d0:d1] - a, 0)
        ones[d0:d1] += np.add.reduceat(part, cuts, axis=0, dtype=np.int64)
    bits = (2 * ones > made[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): one row per document; fp is the fingerprint as a signed long."""
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(cols, n):
        sole("simhash", lambda: None)
        return {"doc_id": cols["doc_id"], "fp": fingerprints(cols["text"].to_pylist()).view(np.int64)}

    return over_batches(df, run, pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())]), "doc_id long, fp long")


# --- the generalised pigeonhole join ---------------------------------------------------------------------------


def group_bits(together: np.ndarray, total: int, m: int) -> list[list[int]]:
    """m groups of bits, correlated ones together. together[i, j]: fingerprints with both bits set."""
    p = together / max(total, 1)
    one = np.diag(p)
    var = np.sqrt(np.maximum(one * (1 - one), 1e-12))
    corr = np.abs((p - np.outer(one, one)) / np.outer(var, var))
    np.fill_diagonal(corr, 0)
    free, groups = set(range(BITS)), []
    for k in range(m):
        size = len(free) // (m - k)
        left = sorted(free)
        i, j = max(((i, j) for i in left for j in left if i < j), key=lambda x: (corr[x], -x[0], -x[1])) if len(left) > 1 else (left[0], left[0])
        group = list(dict.fromkeys([i, j]))[:size]
        while len(group) < size:
            group.append(max((b for b in left if b not in group), key=lambda b: (corr[b, group].sum(), -b)))
        free -= set(group)
        groups.append(sorted(group))
    return groups


def project(fp: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of a group, packed from the least."""
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(group):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def flips(width: int, radius: int) -> np.ndarray:
    """Masks with at most radius of width bits set."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in itertools.combinations(range(width), r)], np.uint64)


def near_mass(hist: np.ndarray, radius: int) -> np.ndarray:
    """[t, v]: rows of a histogram over 2^w values at exactly t bits from v."""
    w = int(np.log2(len(hist)))
    out, idx = np.zeros((radius + 1, len(hist))), np.arange(len(hist))
    out[0] = hist
    for t in range(1, radius + 1):
        for c in itertools.combinations(range(w), t):
            out[t] += hist[idx ^ sum(1 << b for b in c)]
    return out


def allocate(cost: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds by dynamic programming. cost[i, t, q]: work of threshold t in partition i; the thresholds add up to radius - m + 1.

    Returns thresholds [m, q] (-1: the partition is not probed) and the total work [q].
    """
    m, _, n = cost.shape
    spend = radius + 1  # each threshold t spends t + 1 units; the units add up to radius + 1
    best = np.full((spend + 1, n), np.inf)
    best[0] = 0
    back = np.zeros((m, spend + 1, n), np.int8)
    for i in range(m):
        new = np.full_like(best, np.inf)
        for s in range(spend + 1):
            for u in range(s + 1):
                now = best[s - u] + (cost[i, u - 1] if u else 0)
                better = now < new[s]
                new[s] = np.where(better, now, new[s])
                back[i, s] = np.where(better, u, back[i, s])
        best = new
    out, s = np.empty((m, n), np.int8), np.full(n, spend)
    for i in reversed(range(m)):
        u = back[i, s, np.arange(n)]
        out[i], s = u - 1, s - u
    return out, best[spend]


def links(nodes: DataFrame, radius: int = 2, m: int | None = None, dear: float = DEAR) -> DataFrame:
    """Edges (a, b), a < b, that connect distinct fingerprints exactly as all pairs within radius would.

    nodes: one column fp, distinct. m: how many partitions, chosen by MANY if not given. Every pair within radius is an edge unless both its ends lie in a crowded
    region; there a path of edges joins them. radius 2 is the only one with the exact way for crowded regions.
    """
    assert radius == 2, "crowded regions are solved for a radius of 2"

    def together(cols, n):
        b = np.unpackbits(np.asarray(cols["fp"]).view(np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        c = (b.T @ b).astype(np.int64)
        i, j = np.triu_indices(BITS)
        return {"k": np.concatenate([i * BITS + j, [-1]]), "c": np.concatenate([c[i, j], [n]])}

    pairs = over_batches(nodes.select("fp"), together, pa.schema([("k", pa.int64()), ("c", pa.int64())]), "k long, c long").groupBy("k").agg(F.sum("c").alias("c")).collect()
    counts = np.zeros((BITS, BITS))
    total = 0
    for k, c in pairs:  # 2081 rows, whatever the size of the corpus
        if k < 0:
            total = c
        else:
            counts[k // BITS, k % BITS] = counts[k % BITS, k // BITS] = c
    m = m or (3 if total < MANY else 2)
    groups = group_bits(counts, total, m)
    low = [len(g) // 2 for g in groups]

    def halves(cols, n):
        fp = np.asarray(cols["fp"]).view(np.uint64)
        ks, cs = [], []
        for i, g in enumerate(groups):
            v = project(fp, g).astype(np.int64)
            for h, x in enumerate((v & ((1 << low[i]) - 1), v >> low[i])):
                at, c = np.unique(x, return_counts=True)
                ks.append((2 * i + h) << 20 | at)
                cs.append(c)
        return {"k": np.concatenate(ks), "c": np.concatenate(cs)}

    hist = [np.zeros(1 << w) for i, g in enumerate(groups) for w in (low[i], len(g) - low[i])]
    for k, c in over_batches(nodes.select("fp"), halves, pa.schema([("k", pa.int64()), ("c", pa.int64())]), "k long, c long").groupBy("k").agg(F.sum("c").alias("c")).collect():
        hist[k >> 20][k & 0xFFFFF] = c  # at most 2m * 2^11 rows
    mass = [near_mass(h / max(total, 1), radius) for h in hist]
    masks = [[flips(len(g), t) for t in range(radius + 1)] for g in groups]
    ball = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(BITS, dtype=np.uint64)])

    def work(fp):
        cost = np.empty((m, radius + 1, len(fp)))
        for i, g in enumerate(groups):
            v = project(fp, g).astype(np.int64)
            a, b = v & ((1 << low[i]) - 1), v >> low[i]
            exact = [sum(mass[2 * i][x, a] * mass[2 * i + 1][t - x, b] for x in range(t + 1)) * total for t in range(radius + 1)]
            for t in range(radius + 1):
                cost[i, t] = sum(exact[: t + 1]) + len(masks[i][t])
        return allocate(cost, radius)

    def probes(cols, n):
        """Kind 0..m-1: a value to look up in that partition; m: a neighbour key of a crowded fingerprint."""
        fp = np.asarray(cols["fp"]).view(np.uint64)
        t, dearness = work(fp)
        hot = dearness > dear
        kinds, values, owners = [], [], []

        def put(kind, v, own):
            kinds.append(np.full(v.size, kind, np.int32))
            values.append(v.ravel().view(np.int64))
            owners.append(np.repeat(own, v.shape[1]).view(np.int64))

        for i, g in enumerate(groups):
            v = project(fp, g)
            for x in range(radius + 1):
                some = ~hot & (t[i] == x)
                if some.any():
                    put(i, v[some][:, None] ^ masks[i][x][None, :], fp[some])
        if hot.any():
            put(m, fp[hot][:, None] ^ ball[None, :], fp[hot])
        return {"kind": np.concatenate(kinds or [[]]), "v": np.concatenate(values or [[]]), "q": np.concatenate(owners or [[]])}

    def index(cols, n):
        fp = np.asarray(cols["fp"]).view(np.uint64)
        return {"kind": np.repeat(np.arange(m, dtype=np.int32), n), "v": np.concatenate([project(fp, g).view(np.int64) for g in groups]), "x": np.tile(fp.view(np.int64), m)}

    made = over_batches(nodes.select("fp"), probes, pa.schema([("kind", pa.int32()), ("v", pa.int64()), ("q", pa.int64())]), "kind int, v long, q long")
    held = over_batches(nodes.select("fp"), index, pa.schema([("kind", pa.int32()), ("v", pa.int64()), ("x", pa.int64())]), "kind int, v long, x long")
    full = cut(held.groupBy("kind", "v").agg(F.count("*").alias("n")).where(F.col("n") > dear).select("kind", "v"))
    probed, keys = made.where(F.col("kind") < m), made.where(F.col("kind") == m).select("v", "q")
    if not full.isEmpty():
        inside = held.join(full, ["kind", "v"], "left_semi").select(F.col("x").alias("q"))
        beside = probed.join(full, ["kind", "v"], "left_semi").select("q")
        crowd = inside.unionByName(beside).distinct()
        neighbours = F.transform(F.array(*[F.lit(int(x)) for x in ball.view(np.int64)]), lambda b: F.col("q").bitwiseXOR(b))
        keys = keys.unionByName(crowd.select(F.explode(neighbours).alias("v"), "q"))
        probed = probed.join(full, ["kind", "v"], "left_anti")
    near = (
        probed.join(held, ["kind", "v"])
        .where((F.col("q") != F.col("x")) & (F.bit_count(F.col("q").bitwiseXOR(F.col("x"))) <= radius))
        .select(F.least("q", "x").alias("a"), F.greatest("q", "x").alias("b"))
    )
    crowded = keys.join(keys.groupBy("v").agg(F.min("q").alias("least")), "v").where(F.col("q") != F.col("least")).select(F.col("least").alias("a"), F.col("q").alias("b"))
    return near.unionByName(crowded).distinct()


def stars(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (node, root), root the least node; roots have no row.

    Alternating star contraction: each round is two aggregations and joins, and rounds end when a round changes
    nothing. Edges and the aggregates are cut by a checkpoint each round, so that joins on a hub read both their sides
    from shuffles that Spark can split.
    """
    e = cut(edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.min("b").alias("l")).select("a", F.least("a", "l").alias("l")))
        large = cut(both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("l").alias("a"), "b").where(F.col("a") != F.col("b")).distinct())
        down = cut(large.groupBy("b").agg(F.min("a").alias("l")))
        small = large.join(down, "b").select(F.col("l").alias("a"), F.explode(F.array("a", "b")).alias("b")).where(F.col("a") != F.col("b")).distinct()
        e = cut(small)
        with tidy(e.sparkSession):
            state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return e.select(F.col("b").alias("node"), F.col("a").alias("root"))
        seen = state


def near_duplicates(docs: DataFrame, radius: int = 2, m: int | None = None, dear: float = DEAR) -> DataFrame:
    """One row per document: doc_id, fp (signed), component_id.

    Null, empty and word-free texts have fingerprint zero and link like any other. A null doc_id has a row; it never
    names a component unless its fingerprints' component has no other id, and then component_id is null. Repeated
    rows stay. Extra columns are not carried.
    """
    fps = cut(with_fingerprints(docs))
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    star = stars(links(nodes, radius, m, dear))
    members = star.unionByName(star.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "fp").join(nodes, "fp")
    least = cut(members.groupBy("root").agg(F.min("rep").alias("component_id")))
    linked = members.join(least, "root").select("fp", "component_id")
    # cut, so that the last join reads both its sides from shuffles that Spark can split where a fingerprint is hot
    of = cut(nodes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "rep").alias("component_id")))
    return fps.join(of, "fp").select("doc_id", "fp", "component_id")
