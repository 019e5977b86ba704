"""SentencePiece encoding and decoding over a public vocabulary, by a batched Viterbi search.

A text gets a space before it, spaces become the piece mark, and the
segmentation with the greatest sum of piece scores wins. No piece has a mark or
a line feed after another character, so units (spaces and what follows them)
are segmented apart, all units of one length together. A character that is no
piece is written as its UTF-8 bytes, each a byte piece; so is a mark that stands
in the text itself, which makes decoding exact.

The file keeps ranks of merges and no probabilities; a piece's score is the log
probability that its rank has under Zipf's law, as a multiple of 2^-20, so that
sums are exact. A byte piece scores BYTE. A unit of more than LONG characters is
segmented by itself, in blocks.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pieces as P
from .common import over_batches, sole, tokenizer_path
from .wordids import WordIds

VOCABULARY = "piece_bpe_32k.model"
BYTE = -16.0
UNIT = re.compile(r"\n| *[^ \n]+| +")
LONG = 1024
MARK, FOREIGN = ord(P.SPACE), 0x110000


def scores(n: int) -> np.ndarray:
    weight = 1.0 / (np.arange(n) + 2.7)
    return np.rint(np.log(weight / weight.sum()) * 2**20) / 2**20


class Codec(WordIds):
    def __init__(self, vocabulary: str = VOCABULARY):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(vocabulary))
        texts, ids = P.vocabulary(vocabulary)
        if any(not re.fullmatch(f"{P.SPACE}*[^{P.SPACE}\n]*|\n", t) for t in texts):
            raise ValueError("a piece reaches over a space or a line feed")
        self.table, self.ids = P.pieces(vocabulary), np.array(ids, np.uint32)
        self.score = scores(len(texts))
        self.byte_ids = np.zeros(256, np.uint32)
        blob = [b""] * model.get_piece_size()
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:5], 16)
                self.byte_ids[value], blob[i] = i, bytes([value])
        for t, i in zip(texts, ids):
            blob[i] = t.replace(P.SPACE, " ").encode()
        self.blob = np.frombuffer(b"".join(blob), np.uint8)
        self.width = np.fromiter(map(len, blob), np.int64, len(blob))
        self.place = np.cumsum(self.width) - self.width
        super().__init__()

    def split(self, text: str) -> list[str]:
        return UNIT.findall(" " + text) if text else []

    def learn(self, new: set[str]) -> None:
        for _, words in P.by_length(list(new)):
            codes = P.codes_of(words).copy()
            codes[codes == MARK] = FOREIGN
            codes[codes == 32] = MARK
            n = codes.shape[1]
            size = np.select([codes < 0x80, codes < 0x800, (codes < 0x10000) | (codes == FOREIGN)], [1, 2, 3], 4)
            if n > LONG:
                for i, w in enumerate(words):
                    self.append([w], *self._bytes(w, *P.long_viterbi(self.table, codes[i], self.score, size[i] * BYTE)))
                continue
            lattice = self.table.lattice(codes)
            back = P.viterbi(lattice, self.score, size * BYTE, n)
            self.append(words, *self._trace(words, lattice, back, n))

    def _bytes(self, word: str, tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(how many ids, the ids) of a word from its pieces; a character that is none becomes its bytes."""
        odd = np.flatnonzero(tokens == P.MISSING)
        raw = [word[i].encode() for i in starts[odd].tolist()]
        size = np.ones(len(tokens), np.int64)
        size[odd] = list(map(len, raw))
        ids = np.repeat(self.ids[np.maximum(tokens, 0)], size)
        if raw:
            ids[np.repeat(tokens == P.MISSING, size)] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return np.array([len(ids)]), ids

    def _trace(self, words: list[str], lattice: list[np.ndarray], back: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.arange(len(words))
        at, steps = np.full(len(words), n), []
        while (live := at > 0).any():
            r = rows[live]
            took = back[r, at[r]]
            token = np.full(len(words), -2, np.int64)
            for k in np.unique(took):
                some = r[took == k]
                token[some] = lattice[k - 1][some, at[some] - k]
            char = at - 1
            at[r] -= took
            steps.append((token, char))
        out, sizes = [], np.empty(len(words), np.int64)
        tokens = np.stack([t for t, _ in reversed(steps)], axis=1)
        chars = np.stack([c for _, c in reversed(steps)], axis=1)
        odd = (tokens == P.MISSING).any(1)
        for i in range(len(words)) if odd.any() else ():
            if odd[i]:
                row = []
                for t, c in zip(tokens[i].tolist(), chars[i].tolist()):
                    if t >= 0:
                        row.append(int(self.ids[t]))
                    elif t == P.MISSING:
                        row += self.byte_ids[list(words[i][c].encode())].tolist()
                out.append((i, row))
        if not out:
            keep = tokens >= 0
            return keep.sum(1), self.ids[tokens[keep]]
        special = dict(out)
        rows_ids = [special[i] if odd[i] else self.ids[tokens[i][tokens[i] >= 0]] for i in range(len(words))]
        sizes[:] = [len(x) for x in rows_ids]
        return sizes, np.concatenate([np.asarray(x, np.uint32) for x in rows_ids])

    def decode(self, ids: np.ndarray, offs: np.ndarray) -> list[bytes]:
        """The UTF-8 bytes of each text, from ids as encode() returns them."""
        width = self.width[ids]
        ends = np.cumsum(width)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.blob[np.arange(total) + np.repeat(self.place[ids] - (ends - width), width)].tobytes()
        cuts = np.concatenate([[0], ends])[offs].tolist()
        return [raw[a + 1 : b] for a, b in zip(cuts[:-1], cuts[1:])]


def codec(vocabulary: str = VOCABULARY) -> Codec:
    return sole(("codec", vocabulary), lambda: Codec(vocabulary))


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids): the piece ids of each whole text; none for a null or empty text."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(cols, n):
        ids, offs = codec(vocabulary).encode(cols["text"].to_pylist())
        return {"doc_id": cols["doc_id"], "ids": pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(ids.astype(np.int32)))}

    return over_batches(df, run, pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))]), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give a null text."""

    def run(cols, n):
        lists = cols["ids"]
        flat = np.asarray(lists.flatten()).astype(np.int64)
        sizes = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
        texts = codec(vocabulary).decode(flat, np.concatenate([[0], np.cumsum(sizes)]))
        return {"doc_id": cols["doc_id"], "text": pa.array([t.decode("utf-8", "replace") if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist())], pa.string())}

    return over_batches(encoded.select("doc_id", "ids"), run, pa.schema([("doc_id", pa.int64()), ("text", pa.string())]), "doc_id long, text string", text=None)


def digest(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document: doc_id, n_pieces, ids_crc32 (little-endian unsigned 32-bit ids), n_bytes, round_trip (decoding gives the text)."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("n_bytes", pa.int64()), ("round_trip", pa.bool_())])

    def run(cols, n):
        texts = cols["text"].to_pylist()
        ids, offs = codec(vocabulary).encode(texts)
        raw = memoryview(ids.astype("<u4", copy=False).tobytes())
        back = codec(vocabulary).decode(ids, offs)
        at = offs.tolist()
        return {
            "doc_id": cols["doc_id"],
            "n_pieces": np.diff(offs),
            "ids_crc32": np.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:])], np.int64),
            "n_bytes": np.fromiter(map(len, back), np.int64, n),
            "round_trip": pa.array([t.encode() == b for t, b in zip(texts, back)]),
        }

    return over_batches(df, run, schema, "doc_id long, n_pieces long, ids_crc32 long, n_bytes long, round_trip boolean")
