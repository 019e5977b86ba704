"""What each filter removes at each place of each order of filters.

A document's five failures make a mask; a part's masks make at most 32 cells
with counts, which one aggregation gives. The 120 orders are then walked by
single swaps of neighbours: a swap changes two steps only, which are counted
anew from the cells, and every step's removals add to the Shapley sum of its
filter as the walk goes.

A: under 100 words. B: distinct words under 80 % of words. C: capitals over
10 % of code points. D: any of #$%&*|. E: the text of a smaller doc_id, in the
whole table.

Null texts count as empty and null languages as the empty string. A row
without a doc_id never fails E and makes no other row fail it; rows that share
a doc_id don't fail E through each other. Labels that repeat a doc_id count as
one: 1 if any is. Without documents there is no part and no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, over_batches

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
CAPITALS, SIGNS = bytes(range(65, 91)), b"#$%&*|"


def own_failures(text: bytes, points: int) -> int:
    """The mask of failures A to D of a text of so many code points."""
    words = text.split()  # of bytes: at \x20 and \x09-\x0D
    n = len(words)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (n < 100) | (100 * len(set(words)) < 80 * n) << 1 | (100 * capitals > 10 * points) << 2 | (len(text.translate(None, SIGNS)) < len(text)) << 3


def marked(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask): failures A to D, and a digest that equal texts share."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def fn(c: dict, n: int) -> dict:
        points = pc.utf8_length(c["text"]).to_pylist()
        texts = c["text"].cast(pa.binary()).to_pylist()
        return {"doc_id": c["doc_id"], "part": c["part"], "digest": [hashlib.sha256(t).digest() for t in texts], "mask": [own_failures(t, k) for t, k in zip(texts, points)]}

    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("mask", pa.int32())])
    return over_batches(rows, fn, schema, "doc_id long, part string, digest binary, mask int")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and by the filters they fail.

    At first every row counts as a copy; then the rows of the least doc_id of each digest, found by an aggregation that
    combines before it shuffles, move to the cell without E. So a group of copies, whatever its size, meets in no task.
    """
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    rows = cut(marked(docs).join(known, "doc_id", "left").select("doc_id", "part", "digest", "mask", zero("good"), zero("toxic")))
    sums = [F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")]
    named = rows.where(F.col("doc_id").isNotNull())
    by_id = named.groupBy("doc_id", "digest", "mask", "part").agg(*sums).groupBy("doc_id", "digest", "mask").agg(F.collect_list(F.struct("part", "n", "good", "toxic")).alias("parts"))
    first = by_id.groupBy("digest").agg(F.min_by(F.struct("mask", "parts"), "doc_id").alias("f")).select("f.mask", F.explode("f.parts").alias("p")).select("mask", "p.*")
    moved = [first.select("part", (F.col("mask").bitwiseOR(F.lit(bit))).alias("mask"), *[(sign * F.col(c)).alias(c) for c in ("n", "good", "toxic")]) for bit, sign in ((COPY, -1), (0, 1))]
    every = rows.select("part", F.when(F.col("doc_id").isNull(), F.col("mask")).otherwise(F.col("mask").bitwiseOR(F.lit(COPY))).alias("mask"), F.lit(1).cast("long").alias("n"), "good", "toxic")
    whole = every.unionByName(moved[0]).unionByName(moved[1]).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    return whole.where(F.col("n") > 0)


def swaps(n: int) -> Iterator[int]:
    """The places i, each to be swapped with i + 1, that lead through all orders of n things (Steinhaus, Johnson, Trotter)."""
    order, way = list(range(n)), [-1] * n
    while True:
        free = [x for i, x in enumerate(order) if 0 <= i + way[x] < n and order[i + way[x]] < x]
        if not free:
            return
        top = max(free)
        i = order.index(top)
        j = i + way[top]
        order[i], order[j] = order[j], order[i]
        way = [-w if x > top else w for x, w in enumerate(way)]
        yield min(i, j)


class Step(NamedTuple):
    removed: int
    good: int
    toxic: int


def walk(cells: Iterable[tuple[int, int, int, int]], filters: str = FILTERS) -> Iterator[tuple]:
    """(order, step from 1, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part's cells (mask, n, good, toxic)."""
    cells, bit = list(cells), {f: 1 << i for i, f in enumerate(filters)}
    total = sum(n for _, n, _, _ in cells)
    fails = {f: sum(n for m, n, _, _ in cells if m & b) for f, b in bit.items()}
    alone = {f: sum(n for m, n, _, _ in cells if m == b) for f, b in bit.items()}

    def step(order: list[str], i: int) -> Step:
        before, b = sum(bit[f] for f in order[:i]), bit[order[i]]
        hit = [c for c in cells if c[0] & b and not c[0] & before]
        return Step(*(sum(c[k] for c in hit) for k in (1, 2, 3)))

    order = list(filters)
    steps = [step(order, i) for i in range(len(order))]
    shapley, seen = dict.fromkeys(filters, 0), []
    for at in [None, *swaps(len(filters))]:
        if at is not None:
            order[at], order[at + 1] = order[at + 1], order[at]
            steps[at], steps[at + 1] = step(order, at), step(order, at + 1)
        for f, s in zip(order, steps):
            shapley[f] += s.removed
        seen.append(("".join(order), tuple(steps)))
    for name, steps in seen:
        kept = total
        for i, (f, s) in enumerate(zip(name, steps)):
            kept -= s.removed
            yield name, i + 1, kept, s.removed, fails[f] - s.removed, alone[f], s.good, s.toxic, shapley[f]


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, each of the 120 orders and each of its five steps, with counts of documents of the part."""
    parts = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
    schema = pa.schema(list(zip(COLUMNS, types)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(*[batch.column(i).to_pylist() for i in (0, 1)]):
                rows = [(part, *r) for r in walk(tuple(c.values()) for c in found)]
                yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*rows), types)], schema=schema)

    return parts.mapInArrow(run, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")
