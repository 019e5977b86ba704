"""First-wins duplicates, exact-duplicate rates, and greedy near-duplicates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, MapType, StructType, VariantType

from ..functions.text import normal_form


def first_wins(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """Of the rows that share a key one, the first by order, ties by what else the row holds; rows with a null key go.

    Each task brings its own winners only: the least row of a key's digest is carried through an aggregation that
    combines before it shuffles, so a key with very many rows burdens no task, and df is evaluated once. Rows alike in
    everything are one row afterwards.
    """
    names = df.columns
    rest = [n for n in names if n not in order]
    whole = F.struct(*[F.col(f"`{n}`").alias(n) for n in [*order, *rest]])
    orderable = [n for n in rest if not _holds_unordered(df.schema[n].dataType)]
    least = F.min(whole) if len(orderable) == len(rest) else F.min_by(whole, F.struct(*[F.col(f"`{n}`") for n in [*order, *orderable]]))
    rows = df.withColumn("__k", F.sha2(key, 256)).where(F.col("__k").isNotNull())
    return rows.groupBy("__k").agg(least.alias("__r")).select(*[F.col(f"__r.`{n}`").alias(n) for n in names])


def _holds_unordered(kind: DataType) -> bool:
    """Whether values of a type can't be compared."""
    if isinstance(kind, StructType):
        return any(_holds_unordered(f.dataType) for f in kind)
    return isinstance(kind, (MapType, VariantType)) or isinstance(kind, ArrayType) and _holds_unordered(kind.elementType)


def corpus_key(url: str = "url", content: str = "content") -> Column:
    """The url, else the content, else null."""
    return F.coalesce(F.nullif(F.col(url), F.lit("")), F.nullif(F.col(content), F.lit("")))


def url_or_hash(df: DataFrame, url: str, digest: str, order: list[str]) -> DataFrame:
    """Distinct by url, then by digest, the first by order each time."""
    return first_wins(first_wins(df, F.col(url), order), F.col(digest), order)


def exact_duplicates(df: DataFrame, group: list[str], text: str = "text", least: int = 50) -> DataFrame:
    """By group: total rows of `least` characters or more, exact_dups (rows whose normal form an earlier row has), exact_dup_pct.

    Counts distinct normal forms in two steps, so copies meet before they are shuffled.
    """
    rows = df.where(F.length(F.trim(text)) >= least).select(*group, F.md5(normal_form(text)).alias("h"))
    counted = rows.groupBy(*group, "h").agg(F.count("*").alias("n"))
    out = counted.groupBy(*group).agg(F.sum("n").alias("total"), (F.sum("n") - F.count("*")).alias("exact_dups"))
    return out.withColumn("exact_dup_pct", F.round(F.try_divide(100.0 * F.col("exact_dups"), F.col("total")), 2))


# --- near duplicates by MinHash ----------------------------------------------------------------------------------


#: Values of permutations that are made at once.
CELLS = 1 << 14


def _shingle_hashes(text: str, width: int) -> np.ndarray:
    """Hashes of the distinct shingles of a text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(len(codes) - width + 1, np.uint64)
        for i in range(width):
            h = (h ^ codes[i : len(codes) - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return np.unique(h)


def _bands(texts: pd.Series, bands: int, rows: int, width: int) -> list[np.ndarray | None]:
    """MinHash values under bands * rows affine permutations, hashed by band. A text's cost is one pass for each permutation.

    Permutations go some at a time through a table that stays in the processor's cache, and only the least values are
    shifted, since shifting keeps their order.
    """
    rng = np.random.default_rng(1)
    a = rng.integers(1, 2**63, bands * rows, dtype=np.uint64) | np.uint64(1)
    b = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
    mix = rng.integers(1, 2**63, rows, dtype=np.uint64) | np.uint64(1)
    out: list[np.ndarray | None] = []
    room = np.empty(CELLS, np.uint64)
    least = np.empty(bands * rows, np.uint64)
    with np.errstate(over="ignore"):
        for t in texts:
            if t is None or len(t) < width:
                out.append(None)
                continue
            h = _shingle_hashes(t, width)
            least[:] = np.iinfo(np.uint64).max
            for lo in range(0, len(h), CELLS):
                part = h[lo : lo + CELLS]
                some = max(1, CELLS // len(part))
                for i in range(0, len(a), some):
                    at = slice(i, i + some)
                    cells = room[: len(a[at]) * len(part)].reshape(-1, len(part))
                    np.multiply(a[at, None], part, out=cells)
                    cells += b[at, None]
                    least[at] = np.minimum(least[at], cells.min(1))
            least >>= np.uint64(8)
            out.append((least.reshape(bands, rows) * mix).sum(1, dtype=np.uint64).view(np.int64))
    return out


def minhash_bands(df: DataFrame, text: str, bands: int = 9, rows: int = 28, width: int = 5, least: int = 500) -> DataFrame:
    """df without its text and with band (array of long): hashes of groups of MinHash values over distinct character shingles."""
    run = F.pandas_udf(lambda s: pd.Series(_bands(s, bands, rows, width)), ArrayType(LongType()))
    norm = df.withColumn("__t", normal_form(text)).where(F.length("__t") >= least)
    return norm.withColumn("band", run("__t")).drop("__t", text)


#: Rows of which one task settles a run in order, where rounds over all of them settle too few.
RUN = 100_000


def greedy_near_duplicates(banded: DataFrame, id_col: str, run: int = RUN) -> DataFrame:
    """(id, retained): rows in order of id; a row that shares a band with a retained earlier row is not retained.

    A row is settled once all its earlier neighbours are: retained if none of them is retained. Neighbours are found
    through bands, not listed as pairs: in each round every band passes on its least retained and least open id. Settled
    rows leave the bands, which keep only their least retained id, so a round reads what is open. Such rounds settle
    groups of copies, however large, at once, but of a chain in which each row is like the one before it only the head.
    So after a round that settled fewer than `run` rows, the `run` least open rows are settled in order by one task,
    which holds their bands and nothing else; no row outside can come before them. Rounds go on until no row is open.
    """
    keys = banded.select(F.col(id_col).alias("id"), F.explode("band").alias("k")).distinct().checkpoint()
    alone = keys.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("k").checkpoint()
    settled = [keys.select("id").distinct().join(keys.join(alone, "k", "left_semi").select("id").distinct(), "id", "left_anti").withColumn("retained", F.lit(True)).checkpoint()]
    keys = keys.join(alone, "k", "left_semi").checkpoint()
    kept = keys.limit(0).select("k", F.col("id").alias("kept"))

    def settle(now: DataFrame) -> None:
        nonlocal keys, kept
        settled.append(now)
        mine = keys.join(now.where("retained").select("id"), "id", "left_semi").groupBy("k").agg(F.min("id").alias("kept"))
        kept = mine.unionByName(kept).groupBy("k").agg(F.min("kept").alias("kept")).checkpoint()
        keys = keys.join(now, "id", "left_anti").checkpoint()

    while not keys.isEmpty():
        first = keys.groupBy("k").agg(F.min("id").alias("open")).join(kept, "k", "left")
        met = keys.join(first, "k").groupBy("id").agg(F.max(F.coalesce(F.col("kept") < F.col("id"), F.lit(False))).alias("hit"), F.max(F.col("open") < F.col("id")).alias("wait"))
        now = met.where(F.col("hit") | ~F.col("wait")).select("id", (~F.col("hit")).alias("retained")).checkpoint()
        few = now.count() < run
        settle(now)
        if few and not keys.isEmpty():
            last = keys.select("id").distinct().orderBy("id").limit(run).agg(F.max("id")).first()[0]
            settle(_in_order(keys.where(F.col("id") <= last).join(kept, "k", "left")).checkpoint())
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    return out.select("id", "retained")


def _in_order(rows: DataFrame) -> DataFrame:
    """(id, retained) of a bounded run of open rows (id, k, kept), settled one after the other."""

    def run(batches):
        import pyarrow as pa

        held: dict = {}
        for batch in batches:
            for i, k, kept in zip(*[c.to_pylist() for c in batch.columns]):
                held.setdefault(i, []).append((k, kept))
        taken, ids, retained = set(), [], []
        for i in sorted(held):
            free = all((kept is None or kept >= i) and k not in taken for k, kept in held[i])
            if free:
                taken.update(k for k, _ in held[i])
            ids.append(i)
            retained.append(free)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(retained)], names=["id", "retained"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "k", "kept").coalesce(1).mapInArrow(run, f"id {kind}, retained boolean")
