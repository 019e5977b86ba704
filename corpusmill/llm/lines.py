"""Lines that many documents share, dropped from all but the document with the greatest doc_id.

A line's key is the line without white space at its ends, with A-Z in lower
case. Two Bloom filters find the keys that may occur in more than one document:
each key's hash goes to the segment of its top bits, and a hash that the
segment's first filter (once seen) has already goes into its second (twice
seen). The first filters grow with what they hold and never leave their tasks;
the second ones are gathered, bounded by `max_bits` in all, and broadcast. They
miss no repeated key. Where the bound makes them fuller, more keys are
suspected and nothing else changes.

Only suspected lines are then shuffled, as SHA-256 digests, to be counted
exactly; and only texts that hold a suspected line meet their list of dropped
digests. The others are done where they are read.

Null texts count as empty, and an empty text as one empty line. Rows that share
a doc_id count as one document when documents are counted, as do rows without
one; those rank below all others. A key of a row is dropped by its doc_id, so
of repeated rows all keep or all lose a line. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, frugal, over_batches

#: Hashes are dealt out by this many top bits. Bits for each hash in a filter that isn't full; its probes.
SEGMENT_BITS, PER_HASH, PROBES = 12, 16, 3
#: Bits of all second filters together: 32 MB.
MAX_BITS = 1 << 28
#: Hashes that a task holds before it passes them on, each twice at most.
HELD = 1 << 20
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)[:PROBES, None]


def keys_of(text: bytes) -> list[bytes]:
    """The keys of a text's lines, in order. Of bytes, lower() and strip() know A-Z and \\x20 and \\x09-\\x0D alone."""
    return [x.strip() for x in text.lower().split(b"\n")]


def long_keys(keys: list[bytes], least: int) -> set[bytes]:
    """The distinct keys of `least` code points or more."""
    return {k for k in keys if len(k) >= least and (len(k) >= 4 * least or k.isascii() or len(k.decode()) >= least)}


def hashed(keys: Iterable[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)


def places(hashes: np.ndarray) -> np.ndarray:
    """[probe, hash]: numbers whose low bits say which bits a hash sets."""
    with np.errstate(over="ignore"):
        return (hashes[None, :] * MIX) >> np.uint64(20)


class Bloom:
    """Bits for hashes; `size` is a power of two."""

    def __init__(self, size: int):
        self.mask, self.words, self.room = np.uint64(size - 1), np.zeros(max(1, size >> 6), np.uint64), size // PER_HASH

    def add(self, at: np.ndarray) -> None:
        at = (at & self.mask).ravel()
        np.bitwise_or.at(self.words, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        self.room -= at.size // PROBES

    def has(self, at: np.ndarray) -> np.ndarray:
        at = at & self.mask
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).all(0)


class Segment:
    """The hashes of one segment: filters of those seen once, each twice as large as the one before it, and what was seen again."""

    def __init__(self) -> None:
        self.once, self.again = [Bloom(1 << 13)], np.empty(0, np.uint64)

    def take(self, hashes: np.ndarray) -> None:
        hashes, n = np.unique(hashes, return_counts=True)
        at = places(hashes)
        old = np.zeros(len(hashes), bool)
        for b in self.once:
            old |= b.has(at)
        self.again = np.union1d(self.again, hashes[old | (n > 1)])
        fresh = at[:, ~old]
        while fresh.shape[1]:
            if (room := self.once[-1].room) <= 0:
                self.once.append(Bloom(2 * 64 * len(self.once[-1].words)))
                continue
            self.once[-1].add(fresh[:, :room])
            fresh = fresh[:, room:]

    def twice(self, most: int) -> Bloom:
        """The filter of what was seen again, of `most` bits or fewer."""
        out = Bloom(min(most, 1 << max(6, int(PER_HASH * len(self.again)).bit_length())))
        out.add(places(self.again))
        return out


def line_hashes(rows: DataFrame, least: int) -> DataFrame:
    """(h): the hashes of each row's distinct long keys; of those that a task meets again and again, two."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        held, n = [], 0

        def passed() -> pa.RecordBatch:
            h, count = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(h, np.minimum(count, 2)).view(np.int64))], names=["h"])

        for batch in batches:
            for text in batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary()):
                held.append(hashed(long_keys(keys_of(text.as_py()), least)))
                n += len(held[-1])
                if n >= HELD:
                    yield passed()
                    held, n = [], 0
        if n:
            yield passed()

    return rows.select("text").mapInArrow(run, "h long")


class Suspects:
    """All second filters as one array of words."""

    def __init__(self, segments: dict[int, tuple[int, bytes]]):
        size = 1 << SEGMENT_BITS
        self.start, self.mask = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        words, at = [np.zeros(1, np.uint64)], 64  # a segment without a filter looks into an empty word
        for s, (mask, raw) in sorted(segments.items()):
            self.start[s], self.mask[s] = at, mask
            words.append(np.frombuffer(raw, np.uint64))
            at += 64 * len(words[-1])
        self.words = np.concatenate(words)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        s = hashes >> np.uint64(64 - SEGMENT_BITS)
        at = (places(hashes) & self.mask[s]) + self.start[s]
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).all(0)


def suspects(rows: DataFrame, least: int, max_bits: int = MAX_BITS) -> Suspects:
    """The filter of keys that may be in more than one row."""
    most = max(64, max_bits >> SEGMENT_BITS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        found: dict[int, Segment] = {}
        held, n = [], 0

        def settle() -> None:
            h = np.sort(np.concatenate(held))
            s = h >> np.uint64(64 - SEGMENT_BITS)
            for part in np.split(h, np.flatnonzero(s[1:] != s[:-1]) + 1):
                found.setdefault(int(part[0] >> np.uint64(64 - SEGMENT_BITS)), Segment()).take(part)

        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64))
            n += batch.num_rows
            if n >= HELD:
                settle()
                held, n = [], 0
        if n:
            settle()
        made = {s: x.twice(most) for s, x in found.items() if len(x.again)}
        if made:
            columns = [pa.array(list(made), pa.int32()), pa.array([int(b.mask) for b in made.values()], pa.int64()), pa.array([b.words.tobytes() for b in made.values()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["s", "mask", "words"])

    dealt = line_hashes(rows, least).repartition(F.shiftrightunsigned("h", 64 - SEGMENT_BITS))
    return Suspects({r.s: (r.mask, bytes(r.words)) for r in dealt.mapInArrow(run, "s int, mask long, words binary").collect()})  # max_bits in all


def row_key(doc_id: int | None, text: bytes) -> bytes:
    return xxhash.xxh3_128_digest(b"%d:" % doc_id + text if doc_id is not None else b":" + text)


def suspected(keys: list[bytes], least: int, may: Suspects) -> list[bytes]:
    """Digests of a text's long keys that the filter has."""
    found = list(long_keys(keys, least))
    return [hashlib.sha256(found[i]).digest() for i in np.flatnonzero(may.has(hashed(found))).tolist()] if found else []


def drop_repeated(docs: DataFrame, least: int = 20, copies: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): texts without the lines whose key has `least` code points or more and is in
    `copies` (two or more) documents or more, but for the document of the greatest doc_id that holds it.
    """
    if copies < 2:
        raise ValueError("copies: two or more")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    held = rows.sparkSession.sparkContext.broadcast(suspects(rows, least, max_bits))

    def find(c: dict, n: int) -> dict:
        out: dict = {"digest": [], "doc_id": [], "row": []}
        for i, text in zip(c["doc_id"].to_pylist(), c["text"].cast(pa.large_binary()).to_pylist()):
            found = suspected(keys_of(text), least, held.value)
            out["digest"] += found
            out["doc_id"] += [i] * len(found)
            out["row"] += [row_key(i, text)] * len(found) if found else []
        return out

    schema = pa.schema([("digest", pa.binary()), ("doc_id", pa.int64()), ("row", pa.binary())])
    lines = cut(over_batches(rows, find, schema, "digest binary, doc_id long, row binary"))
    counted = lines.select("digest", "doc_id").distinct().groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
    confirmed = cut(counted.where(F.col("n") >= copies).select("digest", "last"))  # read anew, so that the join may split a line that very many hold
    lost = lines.join(confirmed, "digest").where(F.coalesce(F.col("doc_id") < F.col("last"), F.lit(True)))
    dropped = lost.groupBy("row").agg(F.collect_set("digest").alias("gone"))  # a text's own lines at most

    def sort_out(whole: bool):
        """Rows with a suspected line and their key, or the others, done."""

        def fn(c: dict, n: int) -> dict:
            ids, texts = c["doc_id"].to_pylist(), c["text"].cast(pa.large_binary()).to_pylist()
            mine = [i for i, t in enumerate(texts) if whole == (not any_suspect(keys_of(t), least, held.value))]
            out = {"doc_id": c["doc_id"].take(pa.array(mine, pa.int64())), "text": c["text"].take(pa.array(mine, pa.int64()))}
            return out | ({"n_lines": [texts[i].count(b"\n") + 1 for i in mine], "n_dropped": [0] * len(mine)} if whole else {"row": [row_key(ids[i], texts[i]) for i in mine]})

        return fn

    ddl = "doc_id long, text string, n_lines long, n_dropped long"
    done = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])
    untouched = over_batches(rows, sort_out(True), done, ddl)
    open_ = over_batches(rows, sort_out(False), pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("row", pa.binary())]), "doc_id long, text string, row binary")

    def clean(c: dict, n: int) -> dict:
        out: dict = {"doc_id": c["doc_id"], "text": [], "n_lines": [], "n_dropped": []}
        for text, gone in zip(c["text"].cast(pa.large_binary()).to_pylist(), c["gone"].to_pylist()):
            lines, stay = text.split(b"\n"), None
            if gone:
                keys, gone = keys_of(text), set(gone)
                bad = {k for k in long_keys(keys, least) if hashlib.sha256(k).digest() in gone}
                stay = [x for x, k in zip(lines, keys) if k not in bad]
            out["text"].append((text if stay is None else b"\n".join(stay)).decode())
            out["n_lines"].append(len(lines))
            out["n_dropped"].append(0 if stay is None else len(lines) - len(stay))
        return out

    joined = open_.join(dropped, "row", "left").select("doc_id", "text", "gone")
    return untouched.unionByName(over_batches(joined, clean, done, ddl))


def any_suspect(keys: list[bytes], least: int, may: Suspects) -> bool:
    found = long_keys(keys, least)
    return bool(found) and bool(may.has(hashed(found)).any())
