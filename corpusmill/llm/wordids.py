"""Ids of texts put together from remembered ids of their words."""

from __future__ import annotations

from itertools import chain

import numpy as np

#: Words whose ids are put together at once.
RUN = 1 << 17


class WordIds:
    """A subclass says how a text splits into words whose ids do not depend on their neighbours, and learns new words."""

    #: Words, and characters of words, that a worker remembers before it starts anew.
    MOST, MOST_CHARS = 400_000, 6 << 20

    def __init__(self):
        self.forget()

    def split(self, text: str) -> list[str]:
        raise NotImplementedError

    def learn(self, new: set[str]) -> None:
        """Calls append() with each of the new words once."""
        raise NotImplementedError

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.flat, self.n_flat = np.empty(1 << 16, np.uint32), 0
        self.start, self.size = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def remembered(self) -> int:
        return len(self.index)

    def append(self, words: list[str], sizes: np.ndarray, flat: np.ndarray) -> None:
        """Remembers words by how many ids each has and all their ids in a row."""
        base, total = self.remembered(), len(flat)
        while base + len(words) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.empty_like(x)]) for x in (self.start, self.size))
        while self.n_flat + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        at = slice(base, base + len(words))
        self.size[at] = sizes
        self.start[at] = self.n_flat + np.cumsum(sizes) - sizes
        self.flat[self.n_flat : self.n_flat + total] = flat
        self.n_flat += total
        self.index.update(zip(words, range(base, base + len(words))))
        self.chars += sum(map(len, words))

    def places(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(place in the memory of each word of all texts, how many words each text has); new words are learned."""
        words = [self.split(t) for t in texts]
        new = set().union(*words) - self.index.keys() if words else set()
        if new:
            self.learn(new)
        counts = np.fromiter(map(len, words), np.int64, len(words))
        return np.fromiter(map(self.index.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum())), counts

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids begin, with the end of the last)."""
        if self.remembered() > self.MOST or self.chars > self.MOST_CHARS:
            self.forget()
        at, counts = self.places(texts)
        size = self.size[at]
        ends = np.cumsum(size)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
        for lo in range(0, len(at), RUN):  # a run at a time: the places of all ids at once would take more than the ids
            part, n = at[lo : lo + RUN], size[lo : lo + RUN]
            to = ends[lo : lo + RUN]
            first = int(to[0] - n[0])
            ids[first : int(to[-1])] = self.flat[np.arange(int(to[-1]) - first) + np.repeat(self.start[part] - (to - n) + first, n)]
        return ids, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
