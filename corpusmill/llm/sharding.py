"""Shards along a Hilbert curve through metadata space, with DataFrame and SQL functions alone.

Metadata columns are quantised to 2^BITS cells each: numbers at their own
quantiles, strings by their rank among the column's values, whole and in order,
or by quantiles where there are more values than cells. A hot value takes one
cell and the others keep their resolution. The cell's index
on a Hilbert curve orders the rows; runs of the order are cut into shards. Rows
of a shard then span few cells in every dimension, and a filter on any of them
skips most shards by their minima and maxima.

The order is total (curve index, text checksum, id), and ranks come from a range
partitioning on it: a row's rank is its place in its partition plus the sizes of
the partitions before. No task holds a cell, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

DIMENSIONS, BITS = 3, 5
SHARDS = 40
#: Bytes counted for a row besides its text.
ROW_BYTES = 16


def transitions(n: int = DIMENSIONS) -> tuple[list[int], list[int]]:
    """The curve as an automaton: for state * 2^n + corner, the next state and the place of the corner on the curve.

    A state is an entry corner and a direction (entry * n + direction); a corner has a bit for each dimension.
    """
    size, mask = 1 << n, (1 << n) - 1

    def left(x: int, r: int) -> int:
        r %= n
        return ((x << r) | (x >> (n - r))) & mask

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    place_of = {gray(i): i for i in range(size)}
    entry = [0 if i == 0 else gray(2 * ((i - 1) // 2)) for i in range(size)]
    turn = [0 if i == 0 else (_ones(i - 1) if i % 2 == 0 else _ones(i)) % n for i in range(size)]
    after, place = [], []
    for state in range(size * n):
        e, d = divmod(state, n)
        for corner in range(size):
            w = place_of[left(corner ^ e, n - (d + 1) % n)]
            after.append((e ^ left(entry[w], d + 1)) * n + (d + turn[w] + 1) % n)
            place.append(w)
    return after, place


def _ones(i: int) -> int:
    """How many one bits end i."""
    return ((~i) & (i + 1)).bit_length() - 1


def hilbert(cells: list[Column], bits: int = BITS) -> Column:
    """The curve index of a point whose coordinates are integers of `bits` bits."""
    n = len(cells)
    after, place = transitions(n)
    steps = []
    for level in reversed(range(bits)):
        corner = F.lit(0)
        for k, c in enumerate(cells):
            corner = corner.bitwiseOR(F.shiftleft(F.shiftright(c.cast("int"), level).bitwiseAND(F.lit(1)), k))
        steps.append(corner)
    table_after, table_place = (F.array(*[F.lit(x) for x in t]) for t in (after, place))
    start = F.struct(F.lit(0).alias("s"), F.lit(0).cast("long").alias("h"))

    def step(acc: Column, corner: Column) -> Column:
        at = acc["s"] * F.lit(1 << n) + corner
        return F.struct(F.get(table_after, at).alias("s"), (acc["h"] * F.lit(1 << n) + F.get(table_place, at)).cast("long").alias("h"))

    return F.aggregate(F.array(*steps), start, step, lambda acc: acc["h"])


def text_bounds(df: DataFrame, column: str, cells: int) -> list[str]:
    """At most cells - 1 values that part the column's values, in their order: all of them but the first if there are no
    more, else those in which a further share 1 / cells of the rows is reached. Null comes before all."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("v")).agg(F.count("*").alias("n"))
    few = sorted(r.v for r in counts.select("v").limit(cells + 1).collect())
    if len(few) <= cells:
        return few[1:]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(counts.repartitionByRange(parts, "v").withColumn("p", F.spark_partition_id()))
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("p").agg(F.sum("n").alias("n"))  # one row a partition
    starts = sums.select("p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy()).alias("all"))
    inside = Window.partitionBy("p").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    at = placed.join(F.broadcast(starts), "p").withColumn("lo", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    share = lambda x: F.floor(x * cells / F.col("all"))
    reached = at.where(share(F.col("lo") + F.col("n")) > share(F.col("lo")))
    return [r.v for r in reached.select("v").orderBy("v").limit(cells - 1).collect()]


def _above(value: Column, bound: Column) -> Column:
    return value > bound


def _from(value: Column, bound: Column) -> Column:
    return value >= bound


def quantised(df: DataFrame, dims: list[str], texts: list[str] = (), bits: int = BITS) -> Callable[[DataFrame], DataFrame]:
    """A function that replaces the columns of rows like df's by their cells: a number by how many of df's 2^bits - 1
    quantiles lie below it, a string by how many of the bounds of df's values it reaches."""
    shares = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    found = df.agg(*[F.percentile_approx(d, shares, F.lit(10_000)).alias(d) for d in dims]).first()
    out = {}
    for d in dims:
        bounds = F.array(*[F.lit(float(x)) for x in found[d] or [0.0]])
        out[d] = F.size(F.filter(bounds, partial(_above, F.col(d))))
    for d in texts:
        found_bounds = text_bounds(df, d, 1 << bits)
        bounds = F.array(*[F.lit(x) for x in found_bounds]).cast("array<string>")
        apart = (1 << bits) // (len(found_bounds) + 1)  # few values spread over all cells, so that the curve parts them first
        out[d] = F.size(F.filter(bounds, partial(_from, F.coalesce(F.col(d), F.lit(""))))) * apart
    return lambda rows: rows.withColumns(out)


def ranked(df: DataFrame, keys: list[str], parts: int | None = None) -> tuple[DataFrame, int]:
    """(df with rank, gapless from 0 in the order of keys; the number of rows). df holds narrow columns alone."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id()))
    part, place = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("p")).agg(F.count("*").alias("n"))  # one row a partition
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    out = placed.withColumn("p", part).join(F.broadcast(starts), "p").withColumn("rank", F.col("before") + place)
    return out.drop("p", "before", "__id"), placed.count()


#: What orders the rows: all are whole numbers, a null id before all others.
ORDER = ["curve", "text_crc32", "id", "size"]


def _measured(docs: DataFrame) -> DataFrame:
    """Id, size, checksum and dimensions of every document, and __row if it is there."""
    data = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "utf-8")
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(doc_id, F.lit(-(2**63))).alias("id"),
        (F.octet_length(data) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.col("source").cast("string").alias("d0"),
        F.col("lang").cast("string").alias("d1"),
        *[c for c in docs.columns if c == "__row"],
    ).withColumn("d2", F.col("size").cast("double"))


def _placed(docs: DataFrame, shards: int, law: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """(rows with shard and slot; a function that adds the curve to measured rows)."""
    if law not in ("rows", "bytes"):
        raise ValueError(f"law {law!r}: the curve keeps rows or bytes")
    base = cut(_measured(docs))  # narrow; the quantiles, the bounds of the ranges and the rows come from one reading of the texts
    cell = quantised(base, ["d2"], ["d0", "d1"])

    def curved(df: DataFrame) -> DataFrame:
        return cell(df).withColumn("curve", hilbert([F.col("d0"), F.col("d1"), F.col("d2")])).drop("d0", "d1", "d2")

    out, total = ranked(curved(base), ORDER)
    if law == "rows":
        out = out.withColumn("shard", F.expr(f"cast(rank * {shards} div {max(total, 1)} as int)"))
        first = F.expr(f"(cast(shard as long) * {max(total, 1)} + {shards - 1}) div {shards}")
        out = out.withColumn("slot", F.col("rank") - first)
    else:
        out = by_bytes(out, shards)
    return out, curved


def assign(docs: DataFrame, shards: int = SHARDS, law: str = "rows") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null), curve, for every document.

    Dimensions: source, language and size. law "rows": shards' numbers of rows are at most one apart; "bytes": a row
    goes to the shard in which the middle of its bytes falls, so sizes differ by about a row. Null texts have no bytes
    and the checksum of the empty text; null sources and languages take the first cell. Repeated rows are rows.
    """
    out, _ = _placed(docs, shards, law)
    return out.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve")


def by_bytes(rows: DataFrame, shards: int, chunk: int = 4096) -> DataFrame:
    """shard and slot from ranked rows by their bytes: sums of chunks of ranks first, then places inside a chunk."""
    rows = cut(rows.withColumn("c", F.floor(F.col("rank") / chunk).cast("long")))
    sums = rows.groupBy("c").agg(F.sum("size").alias("b")).withColumn("g", F.floor(F.col("c") / chunk).cast("long"))
    groups = sums.groupBy("g").agg(F.sum("b").alias("b"))
    over = lambda part, key: Window.partitionBy(*part).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    base = groups.select("g", F.coalesce(F.sum("b").over(over([], "g")), F.lit(0)).alias("gb"), F.sum("b").over(Window.partitionBy()).alias("all"))
    starts = sums.join(base, "g").select("c", "all", (F.col("gb") + F.coalesce(F.sum("b").over(over(["g"], "c")), F.lit(0))).alias("cb"))
    inside = rows.join(starts, "c").withColumn("at", F.col("cb") + F.coalesce(F.sum("size").over(over(["c"], "rank")), F.lit(0)))
    placed = cut(inside.withColumn("shard", F.least(F.lit(shards - 1), F.floor((F.col("at") + F.col("size") / 2) * shards / F.col("all"))).cast("int")))
    firsts = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("rank") - F.col("first"))


def write(docs: DataFrame, path: str, shards: int = SHARDS, law: str = "rows") -> None:
    """The documents as Parquet under path, a folder for each shard, rows in curve order.

    A row finds its shard by the first row of each shard, so ids may repeat or be null; rows that are alike in curve,
    checksum, id and size stay together.
    """
    placed, cells = _placed(docs, shards, law)
    firsts = placed.where(F.col("slot") == 0).select("shard", *ORDER).orderBy("shard").collect()  # one row a shard
    where = _measured(docs.select("*", F.struct("*").alias("__row")))
    key = F.struct(*ORDER)
    bounds = F.array(*[F.struct(*[F.lit(r[k]).cast("long").alias(k) for k in ORDER]) for r in firsts])
    numbers = F.array(*[F.lit(r.shard) for r in firsts])
    rows = cells(where).withColumn("shard", F.get(numbers, F.size(F.filter(bounds, partial(_from, key))) - 1))
    rows.repartition(shards, "shard").sortWithinPartitions("shard", *ORDER).select("__row.*", "shard").write.partitionBy("shard").parquet(path)
