"""A fixed vocabulary of pieces, and lattices over batches of equally long words.

Substrings are found by hash: a polynomial hash of every substring of every word
of a batch probes the sorted hashes of the pieces. Words of one length advance
together, one position at a time, so the inner loops are numpy operations over
all words of that length. A long word advances in blocks that do so too: what a
block does to the last few positions before it is a small matrix, and the
blocks' matrices are multiplied in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from .common import tokenizer_path

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SALT = np.uint64(0xD6E8FEB86659FD93)
SPACE = "▁"
MISSING = -1


def codes_of(words: list[str]) -> np.ndarray:
    """Code points of equally long words, one row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(positions, words) for each length, the empty word left out, in runs of bounded size."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for at in np.split(order, cuts) if len(order) else []:
        n = int(lengths[at[0]])
        step = max(1, 400_000 // max(n, 1))
        for lo in range(0, len(at), step):
            if n:
                yield at[lo : lo + step], [words[i] for i in at[lo : lo + step]]


class Pieces:
    """texts[i]: the i-th piece; pieces are distinct and not empty."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.longest = max(map(len, texts))
        keys = np.empty(len(texts), np.uint64)
        for at, some in by_length(texts):
            prefix = self._prefixes(codes_of(some))
            keys[at] = self._key(prefix, len(some[0]))[:, 0]
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        if (np.diff(self.keys) == 0).any():
            raise ValueError("two pieces share a hash")
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.keys >> np.uint64(44)] = True

    @staticmethod
    def _prefixes(codes: np.ndarray) -> np.ndarray:
        out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(codes.shape[1]):
                out[:, j + 1] = (out[:, j] + np.uint64(1)) * BASE + codes[:, j].astype(np.uint64) * SALT
        return out

    @staticmethod
    def _key(prefix: np.ndarray, length: int) -> np.ndarray:
        """Keys of all substrings of a length: that of the substring alone, whatever stands before it."""
        with np.errstate(over="ignore"):
            power = np.uint64(1)
            for _ in range(length):
                power = power * BASE
            x = prefix[:, length:] - prefix[:, : prefix.shape[1] - length] * power + np.uint64(length) * SALT
            x = (x ^ (x >> np.uint64(29))) * BASE
            return x ^ (x >> np.uint64(32))

    def find(self, keys: np.ndarray) -> np.ndarray:
        flat = keys.ravel()
        out = np.full(flat.shape, MISSING, np.int32)
        some = np.flatnonzero(self.maybe[flat >> np.uint64(44)])
        if len(some):
            want = flat[some]
            at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            hit = self.keys[at] == want
            out[some[hit]] = self.order[at[hit]]
        return out.reshape(keys.shape)

    def lattice(self, codes: np.ndarray) -> list[np.ndarray]:
        """[l - 1][w, i]: the piece that covers i..i+l of word w, or MISSING."""
        prefix = self._prefixes(codes)
        return [self.find(self._key(prefix, n)) for n in range(1, min(self.longest, codes.shape[1]) + 1)]


def forward(lattice: list[np.ndarray], p: np.ndarray, length: int) -> np.ndarray:
    """Sums over all segmentations. p[lang, piece + 1]; p[:, 0] is the probability of a character that is no piece.

    Returns alpha[j][lang, word] for j = 0..length.
    """
    langs, words = p.shape[0], lattice[0].shape[0]
    alpha = np.zeros((length + 1, langs, words))
    alpha[0] = 1
    for j in range(1, length + 1):
        total = np.zeros((langs, words))
        for n in range(1, min(len(lattice), j) + 1):
            piece = lattice[n - 1][:, j - n]
            if n == 1:
                total += alpha[j - 1] * p[:, piece + 1]
            else:
                some = np.flatnonzero(piece != MISSING)
                if len(some):
                    total[:, some] += alpha[j - n][:, some] * p[:, piece[some] + 1]
        alpha[j] = total
    return alpha


def expected(lattice: list[np.ndarray], p: np.ndarray, length: int, counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (index 0: unknown characters) over all segmentations. counts[lang, word]."""
    alpha = forward(lattice, p, length)
    langs, words = counts.shape
    beta = np.zeros((length + 1, langs, words))
    beta[length] = 1
    out = np.zeros_like(p)
    scale = counts / np.maximum(alpha[length], 1e-300)
    for i in range(length - 1, -1, -1):
        total = np.zeros((langs, words))
        for n in range(1, min(len(lattice), length - i) + 1):
            piece = lattice[n - 1][:, i]
            some = np.arange(words) if n == 1 else np.flatnonzero(piece != MISSING)
            if not len(some):
                continue
            step = p[:, piece[some] + 1] * beta[i + n][:, some]
            total[:, some] += step
            used = alpha[i][:, some] * step * scale[:, some]
            for k in range(langs):
                out[k] += np.bincount(piece[some] + 1, weights=used[k], minlength=p.shape[1])
        beta[i] = total
    return out


def viterbi(lattice: list[np.ndarray], score: np.ndarray, unknown: np.ndarray, length: int) -> np.ndarray:
    """Backpointers [word, j]: how long the last piece of the best segmentation of the first j characters is.

    score[piece]; unknown[word, i]: the score of character i by itself where it is no piece. Ties go to the
    longer last piece.
    """
    words = lattice[0].shape[0]
    best = np.full((length + 1, words), -np.inf)
    best[0] = 0
    back = np.zeros((words, length + 1), np.int32)
    for j in range(1, length + 1):
        for n in range(min(len(lattice), j), 0, -1):
            piece = lattice[n - 1][:, j - n]
            if n == 1:
                now = best[j - 1] + np.where(piece == MISSING, unknown[:, j - 1], score[piece])
                some = np.flatnonzero(now > best[j])
                best[j, some], back[some, j] = now[some], 1
            else:
                some = np.flatnonzero(piece != MISSING)
                if len(some):
                    now = best[j - n, some] + score[piece[some]]
                    up = now > best[j, some]
                    some = some[up]
                    best[j, some], back[some, j] = now[up], n
    return back


#: Characters of a long word whose lattice is held at once.
CHUNK = 1 << 15


def endings(table: Pieces, codes: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """[l - 1, j]: the piece of l characters that ends with character lo + j of one word, or MISSING, up to character hi."""
    base = max(0, lo - table.longest + 1)
    out = np.full((table.longest, hi - lo), MISSING, np.int32)
    for n, found in enumerate(table.lattice(codes[None, base:hi]), 1):
        last = base + np.arange(found.shape[1]) + n - 1
        out[n - 1, last[last >= lo] - lo] = found[0, last >= lo]
    return out


def equal_blocks(n: int) -> list[tuple[int, int, int]]:
    """(first character, blocks, characters of each) that cover n characters."""
    size = max(1, int(n**0.5))
    rest = n % size
    return [(0, n // size, size)] + ([(n - rest, 1, rest)] if rest else [])


def log_forward(table: Pieces, codes: np.ndarray, p: np.ndarray) -> np.ndarray:
    """[language]: log of the sum over all segmentations of one word of any length. p is that of forward()."""
    k, langs = table.longest, len(p)
    padded = np.concatenate([p, np.zeros((langs, 1))], axis=1)
    state, log = np.zeros((k, langs)), np.zeros(langs)  # state[t]: the sum t characters back
    state[0] = 1
    for lo in range(0, len(codes), CHUNK):
        ends = endings(table, codes, lo, min(lo + CHUNK, len(codes)))
        at = np.where(ends == MISSING, p.shape[1], ends + 1)
        at[0] = ends[0] + 1
        for first, n, size in equal_blocks(ends.shape[1]):
            prob = padded[:, at[::-1, first : first + n * size].reshape(k, n, size)]  # the longest piece first
            rows = np.zeros((size + k, langs, n, k))  # the last axis: which state before the block was 1
            for t in range(k):
                rows[k - 1 - t, :, :, t] = 1
            scale = np.zeros((langs, n))
            for i in range(size):
                np.einsum("glb,lgbs->gbs", prob[:, :, :, i], rows[i : i + k], out=rows[i + k])
                if i % 8 == 7 or i + 1 == size:
                    last = rows[i + 1 : i + 1 + k]
                    top = np.maximum(last.max(axis=(0, 3)), 1e-300)
                    last /= top[None, :, :, None]
                    scale += np.log(top)
            turn = rows[size : size + k][::-1]
            for b in range(n):
                state = np.einsum("tgs,sg->tg", turn[:, :, b], state)
                top = np.maximum(state.max(axis=0), 1e-300)
                state /= top
                log += np.log(top) + scale[:, b]
    return log + np.log(np.maximum(state[0], 1e-300))


def long_viterbi(table: Pieces, codes: np.ndarray, score: np.ndarray, unknown: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pieces or MISSING, where each begins) of the best segmentation of one word of any length; viterbi() tells the rest.

    Scores are multiples of one power of two, so sums are exact and blocks decide as single steps would.
    """
    k, n = table.longest, len(codes)
    state = np.full(k, -np.inf)
    state[0] = 0
    back, token = np.empty(n, np.int8 if k < 128 else np.int32), np.empty(n, np.int32)
    for lo in range(0, n, CHUNK):
        hi = min(lo + CHUNK, n)
        ends = endings(table, codes, lo, hi)
        cost = np.where(ends == MISSING, -np.inf, score[ends])
        cost[0] = np.where(ends[0] == MISSING, unknown[lo:hi], cost[0])
        for first, many, size in equal_blocks(hi - lo):
            step = cost[::-1, first : first + many * size].reshape(k, many, size)  # the longest piece first
            rows = np.full((size + k, many, k), -np.inf)
            for t in range(k):
                rows[k - 1 - t, :, t] = 0
            for i in range(size):
                rows[i + k] = (step[:, :, i, None] + rows[i : i + k]).max(axis=0)
            turn = rows[size : size + k][::-1]
            best = np.empty((size + k, many))
            for b in range(many):
                best[k - 1 :: -1, b] = state
                state = (turn[:, b] + state).max(axis=1)
            for i in range(size):
                now = step[:, :, i] + best[i : i + k]
                took = now.argmax(axis=0)  # the first of equals: the longest
                best[i + k] = now[took, np.arange(many)]
                at = lo + first + np.arange(many) * size + i
                back[at] = k - took
                token[at] = ends[k - 1 - took, at - lo]
    cuts, j, sizes = [], n, back.tolist()
    while j:
        cuts.append(j)
        j -= sizes[j - 1]
    last = np.array(cuts[::-1], np.int64) - 1
    return token[last], last + 1 - back[last]


@lru_cache(maxsize=4)
def vocabulary(name: str = "piece_bpe_32k.model") -> tuple[list[str], list[int]]:
    """The text pieces of a public SentencePiece vocabulary with their ids, and after them no control or byte piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
    keep = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return [model.id_to_piece(i) for i in keep], keep


@lru_cache(maxsize=4)
def pieces(name: str = "piece_bpe_32k.model") -> Pieces:
    return Pieces(vocabulary(name)[0])
