"""Tokenised documents packed into sequences of fixed length.

The lengths of the pieces form a histogram of at most `capacity` bins. The
configuration linear programme over it (a configuration: a multiset of lengths
that fits a sequence) is solved by multiplicative weights: each length has a
price, a knapsack dynamic programme finds the dearest configuration, and the
prices of the lengths that it covers fall. The configurations are rounded to
whole numbers of sequences with a few places left open and their room filled,
in several ways of which the best holds; what is left over is placed best fit first. All
of this works on counts, so its cost depends on the histogram and not on the
number of documents; the plan is a bounded table that tells the r-th piece of a
length its sequence and offset.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, over_batches, sole, tokenizer_path
from .wordids import WordIds

CAPACITY, END = 4096, 1
#: Bytes of text tokenised at once: more share more words.
BLOCK = 5 << 20
#: Lengths count as multiples of GRAIN in the programme; rounds of multiplicative weights and their step.
GRAIN, ROUNDS, STEP = 32, 2000, 0.3
#: The solution is rounded with so many places of each configuration left open, and their room filled to the end where
#: that can be, or by the longest that fit; the rounding with fewest sequences holds.
ROUNDINGS = ((1, True), (2, True), (1, False), (2, False), (3, False))


# --- tokens ----------------------------------------------------------------------------------------------------


class WordCache(WordIds):
    """A word is what stands between spaces and line feeds: the tokenizer never joins characters over white space.

    A word of letters with ASCII punctuation after it is taken as its letters and its punctuation, which the
    tokenizer splits too. Words learned anew cost most, so more are remembered than elsewhere: as Arrow strings, which
    take a tenth of what Python's do. index has the words of one block alone that are new, with their letters and ends.
    """

    MOST, MOST_CHARS = 1_000_000, 16 << 20

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        super().__init__()

    def forget(self) -> None:
        super().forget()
        self.known, self.fresh, self.n_words = pa.array([], pa.string()), [], 0

    def remembered(self) -> int:
        return self.n_words

    def append(self, words: list[str], sizes: np.ndarray, flat: np.ndarray) -> None:
        super().append(words, sizes, flat)
        self.fresh.append(pa.array(words, pa.string()))
        self.n_words += len(words)

    def recall(self, words: pa.Array) -> None:
        """Puts known words into index."""
        at = pc.index_in(words, self.known)
        known = pc.is_valid(at)
        self.index.update(zip(words.filter(known).to_pylist(), at.filter(known).to_pylist()))

    def places(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Arrow splits the texts and numbers their words, so only new words become Python strings."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        counts = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        numbered = words.flatten().dictionary_encode()
        found = pc.index_in(numbered.dictionary, self.known)
        new = pc.is_null(found)
        at = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        words = numbered.dictionary.filter(new).to_pylist()
        if words:
            self.learn(words)
            at[new.to_numpy(zero_copy_only=False)] = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
            self.known, self.fresh, self.index = pa.concat_arrays([self.known, *self.fresh]), [], {}
        return at[numbered.indices.to_numpy(zero_copy_only=False)], counts

    def learn(self, new: list[str]) -> None:
        """Most words are Latin letters and punctuation; Arrow tells them and finds the distinct letters, Python sees the rest."""
        words = pa.array(new, pa.string())
        body = pc.ascii_rtrim(words, characters=".,!?;:#*&%$")
        low = pc.if_else(pc.string_is_ascii(body), pc.ascii_lower(body), body)
        latin = pc.match_substring_regex(low, "^[A-Za-zÀ-ÖØ-öø-ÿ]+$")
        rest = words.filter(pc.invert(latin)).to_pylist()
        self._letters([w for w in rest if w.isalpha()])
        self._others([w for w in rest if not w.isalpha()])
        bases = low.filter(latin).dictionary_encode()
        letters = bases.dictionary.to_pylist()
        more = pc.and_(latin, pc.not_equal(words, low))
        split = words.filter(more).to_pylist()
        ends = [w[n:] for w, n in zip(split, pc.utf8_length(body.filter(more)).to_pylist())]
        self.recall(pa.array(list(dict.fromkeys([*letters, *ends])), pa.string()))
        self._letters([b for b in letters if b not in self.index])
        if split:
            self._others([t for t in set(ends) if t not in self.index])
            which = bases.indices.filter(pc.not_equal(words, low).filter(latin)).to_numpy(zero_copy_only=False)
            first = np.fromiter(map(self.index.__getitem__, letters), np.int64, len(letters))[which]
            at = np.stack([first, np.fromiter(map(self.index.__getitem__, ends), np.int64, len(ends))], 1).ravel()
            size, start = self.size[at], self.start[at]
            last = np.cumsum(size)
            flat = self.flat[np.arange(int(last[-1])) + np.repeat(start - (last - size), size)]
            self.append(split, size.reshape(-1, 2).sum(1), flat)

    def _letters(self, words: list[str]) -> None:
        """Words of letters are single words to the tokenizer too, so many are encoded as one text and cut at the ends of words."""
        if not words:
            return
        runs = [" ".join(words[i : i + 2000]) for i in range(0, len(words), 2000)]
        ids = []
        for i in range(0, len(runs), 8):  # an encoding holds much more than its ids
            ids += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(runs[i : i + 8], add_special_tokens=False)]
        flat = np.concatenate(ids)
        last = np.flatnonzero(self.closes[flat])
        if len(last) == len(words):
            self.append(words, np.diff(last, prepend=-1), flat)
        else:
            self._others(words)

    def _others(self, words: list[str]) -> None:
        for i in range(0, len(words), 16_000):
            some = words[i : i + 16_000]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self.append(some, sizes, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())))


def word_cache(name: str) -> WordCache:
    return sole(("packing", name), lambda: WordCache(name))


def token_pieces(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the pieces of every document, with its end token."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(cols, n):
        ids, offs = word_cache(tokenizer).encode(cols["text"])
        tail = np.uint32(end).astype("<u4").tobytes()
        raw, rows = memoryview(ids.astype("<u4", copy=False).tobytes()), []
        for i in range(n):
            a, b = int(offs[i]), int(offs[i + 1])
            total = b - a + 1
            for piece, s in enumerate(range(0, total, capacity)):
                e = min(s + capacity, total)
                crc = zlib.crc32(raw[4 * (a + s) : 4 * min(a + e, b)])
                if e == total:
                    crc = zlib.crc32(tail, crc)
                rows.append((i, piece, s, e - s, crc))
        of, piece, start, length, crc = (np.array(x, np.int64) for x in zip(*rows))
        return {"doc_id": cols["doc_id"].take(pa.array(of)), "piece": piece.astype(np.int32), "start": start, "length": length, "ids_crc32": crc}

    return over_batches(df, run, schema, "doc_id long, piece int, start long, length long, ids_crc32 long", size=BLOCK)


# --- the configuration linear programme ------------------------------------------------------------------------


def dearest(price: np.ndarray, sizes: np.ndarray, have: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of greatest price: an unbounded knapsack by dynamic programming, cut to what there is. sizes ascend."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int32)
    lo = int(sizes[0])
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right").tolist()
    for c in range(lo, capacity + 1):
        now = price[: fits[c]] + best[c - sizes[: fits[c]]]
        i = int(now.argmax())
        if now[i] > best[c - 1]:
            best[c], pick[c] = now[i], i
        else:
            best[c] = best[c - 1]
    out: dict[int, int] = {}
    c = capacity
    while c >= lo:
        i = int(pick[c])
        if i < 0:
            c -= 1
            continue
        out[i] = out.get(i, 0) + 1
        c -= int(sizes[i])
    return {i: int(min(n, have[i])) for i, n in out.items()}


def solve(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS, step: float = STEP) -> list[tuple[dict[int, int], float]]:
    """Configurations {index of a size: copies} with their fractional numbers, by multiplicative weights.

    A size's price starts at its share of a sequence. Each round takes the dearest configuration as often as its
    scarcest size allows, and the prices of what it covers fall by exp(-step * share of the count covered), so sizes
    that lag behind grow dear. Once every size is covered, the whole is scaled to cover the least covered size once.
    """
    price = sizes / capacity
    covered = np.zeros(len(sizes))
    chosen: dict[tuple, float] = {}
    for _ in range(rounds):
        config = dearest(price, sizes, counts, capacity)
        at, n = np.fromiter(config, np.int64, len(config)), np.fromiter(config.values(), np.float64, len(config))
        times = float((counts[at] / n).min())
        key = tuple(sorted(config.items()))
        chosen[key] = chosen.get(key, 0.0) + times
        covered[at] += n * times / counts[at]
        price[at] *= np.exp(-step * n * times / counts[at])
        if price.max() < 1e-200:
            price *= 1e200
    scale = covered.min() if covered.min() > 0 else max(covered.mean(), 1.0)
    return [(dict(k), t / scale) for k, t in chosen.items()]


class Plan:
    """rows[length]: (first rank, one past the last, copies in a sequence, first sequence, offset of the first copy), by rank."""

    def __init__(self):
        self.rows: dict[int, list[tuple[int, int, int, int, int]]] = {}
        self.used: dict[int, int] = {}
        self.sequences = 0

    def add(self, config: list[tuple[int, int]], times: int) -> None:
        """times sequences, each with n pieces of each length of the configuration."""
        offset = 0
        for length, n in config:
            lo = self.used.get(length, 0)
            self.rows.setdefault(length, []).append((lo, lo + n * times, n, self.sequences, offset))
            self.used[length] = lo + n * times
            offset += n * length
        self.sequences += times


def best_fit(left: dict[int, int], capacity: int, opened: list[tuple[list[tuple[int, int]], int]] = ()) -> list[tuple[list[tuple[int, int]], int]]:
    """Best fit decreasing on counts, into opened sequences and new ones: (configuration, times). Alike sequences are handled as one."""
    rooms: list[int] = []  # distinct, ascending
    bins: dict[int, list[tuple]] = {}  # room -> [(configuration, times)]

    def put(config, times):
        room = capacity - sum(a * n for a, n in config)
        if room not in bins:
            insort(rooms, room)
            bins[room] = []
        bins[room].append((config, times))

    for config, times in opened:
        put(config, times)
    for length in sorted(left, reverse=True):
        need = left[length]
        while need:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                n = min(capacity // length, need)
                times = need // n
                put([(length, n)], times)
                need -= n * times
                continue
            room = rooms[i]
            config, times = bins[room].pop()
            if not bins[room]:
                del bins[room]
                rooms.pop(i)
            n = min(room // length, need)
            used = min(times, need // n)
            if times > used:
                put(config, times - used)
            put([*config, (length, n)], used)
            need -= n * used
    return [(c, t) for same in bins.values() for c, t in same]


def rounded(hist: dict[int, int], capacity: int, grain: int, solved: list[tuple[dict[int, int], float]], spare: int, full: bool) -> tuple[list[tuple[list[tuple[int, int]], int]], dict[int, int]]:
    """The solved programme over lengths rounded up to multiples of grain, in whole numbers and true lengths.

    Returns opened sequences (configuration, times) and the counts still to be placed. A configuration gives all its
    places but the `spare` smallest, each to the longest length of its class; the room that is left, which rounding up
    has widened, is filled from all lengths (full: to the end where that can be). Those with the longest places come first.
    """
    have = np.zeros(capacity + 1, np.int64)
    have[list(hist)] = list(hist.values())
    sizes = classes(hist, grain)[0]
    opened = []
    for config, times in sorted(solved, key=lambda x: -max(int(sizes[i]) for i in x[0])):
        places = sorted((int(sizes[i]) for i, n in config.items() for _ in range(n)), reverse=True)[:-spare]
        left = int(times)
        while left and places:
            free, taken = have.copy(), []
            for k in places:
                lo = (k - 1) * grain + 1
                some = np.flatnonzero(free[lo : k * grain + 1])
                if not len(some):
                    break
                taken.append(lo + int(some[-1]))
                free[taken[-1]] -= 1
            if len(taken) < len(places):
                break
            taken += fill(capacity - sum(taken), free, 24 if full else 0)
            lengths, n = np.unique(taken, return_counts=True)
            most = int(min(left, (have[lengths] // n).min()))
            have[lengths] -= n * most
            opened.append(([(int(x), int(c)) for x, c in zip(lengths[::-1], n[::-1])], most))
            left -= most
    return opened, {int(k): int(have[k]) for k in np.flatnonzero(have)}


def classes(hist: dict[int, int], grain: int) -> tuple[np.ndarray, np.ndarray]:
    """(sizes in grains, ascending; how many pieces each has)."""
    lengths, n = np.array(list(hist), np.int64), np.array(list(hist.values()), np.int64)
    sizes, at = np.unique(-(-lengths // grain), return_inverse=True)
    return sizes, np.bincount(at, weights=n).astype(np.int64)


def to_the_end(room: int, free: np.ndarray) -> list[int]:
    """One length, or the two most alike, that fill room to its end; none if there are none."""
    if free[room] > 0:
        return [room]
    a = np.arange(1, room // 2 + 1)
    found = np.flatnonzero((free[a] > 0) & (free[room - a] > (a == room - a)))
    return [room - int(a[found[-1]]), int(a[found[-1]])] if len(found) else []


def fill(room: int, free: np.ndarray, tries: int) -> list[int]:
    """Lengths for a room, taken from free: those that fill it to the end, after one of the `tries` longest if need be;
    the longest that fit where none do, or tries is 0."""
    taken: list[int] = []
    while room > 0:
        now = to_the_end(room, free) if tries else []
        if not now:
            fits = np.flatnonzero(free[: room + 1] > 0)
            if not len(fits):
                break
            now = [int(fits[-1])]
            for x in fits[::-1][:tries].tolist():
                free[x] -= 1
                rest = to_the_end(room - x, free)
                free[x] += 1
                if rest:
                    now = [x, *rest]
                    break
        for x in now:
            free[x] -= 1
            room -= x
        taken += now
    return taken


def plan(hist: dict[int, int], capacity: int = CAPACITY, grain: int = GRAIN, rounds: int = ROUNDS, step: float = STEP) -> Plan:
    """The whole plan for a histogram {length: count}."""
    made, left = Plan(), {k: n for k, n in hist.items() if n}
    if capacity in left:  # full pieces stand alone
        made.add([(capacity, 1)], left.pop(capacity))
    if left:
        solved = solve(*classes(left, grain), capacity // grain, rounds, step)
        found = []
        for spare, full in ROUNDINGS:
            opened, rest = rounded(left, capacity, grain, solved, spare, full)
            found.append(best_fit(rest, capacity, opened))
        for config, times in min(found, key=lambda f: sum(t for _, t in f)):
            made.add(config, times)
    return made


# --- placing ---------------------------------------------------------------------------------------------------


def pack(pieces: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN, rounds: int = ROUNDS, step: float = STEP, parts: int | None = None) -> DataFrame:
    """pieces with sequence_id and offset; pieces has doc_id, piece, length and is computed twice (for the bounds of the ranges too) unless it is cut.

    Pieces of a length are ranked over a range partitioning by (length, doc_id, piece, ...), so that a length that a
    third of the pieces share spreads over tasks; the numbers of rows by partition and length (one row for each
    partition and one more for each length) turn places in a partition into ranks.
    """
    spark = pieces.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["length", "doc_id", "piece", *[c for c in pieces.columns if c not in ("length", "doc_id", "piece")]]
    placed = cut(pieces.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("pid", F.spark_partition_id()))
    counts = placed.groupBy("length", "pid").agg(F.count("*").alias("n")).collect()
    hist: dict[int, int] = {}
    before: dict[tuple[int, int], int] = {}
    for r in sorted(counts, key=lambda r: (r.length, r.pid)):
        before[r.pid, r.length] = hist.get(r.length, 0)
        hist[r.length] = hist.get(r.length, 0) + r.n
    made = plan(hist, capacity, grain, rounds, step)
    tables = {k: np.array(v, np.int64) for k, v in made.rows.items()}
    shared = spark.sparkContext.broadcast((before, tables))
    names = [c for c in placed.columns if c != "pid"]
    out = placed.select(*names, "pid").schema.fieldNames()
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema if f.name != "pid") + ", sequence_id long, offset long"

    def run(batches):
        before, tables = shared.value
        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            length = batch.column(out.index("length")).to_numpy(zero_copy_only=False)
            pid = batch.column(out.index("pid")).to_numpy(zero_copy_only=False)
            if not len(length):
                continue
            new = np.concatenate([[0], np.flatnonzero((np.diff(length) != 0) | (np.diff(pid) != 0)) + 1, [len(length)]])
            seq, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for a, b in zip(new[:-1].tolist(), new[1:].tolist()):
                key = int(pid[a]), int(length[a])
                lo = seen.get(key, before[key])
                seen[key] = lo + b - a
                rank = np.arange(lo, lo + b - a)
                t = tables[key[1]]
                row = t[np.searchsorted(t[:, 1], rank, side="right")]
                inside = rank - row[:, 0]
                seq[a:b] = row[:, 3] + inside // row[:, 2]
                off[a:b] = row[:, 4] + inside % row[:, 2] * key[1]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(names))], pa.array(seq), pa.array(off)], names=[*names, "sequence_id", "offset"])

    return placed.select(*names, "pid").mapInArrow(run, ddl)


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text has the end token alone. Repeated rows are packed each for itself; null ids are allowed.
    """
    return pack(cut(token_pieces(docs, tokenizer, capacity)), capacity)
