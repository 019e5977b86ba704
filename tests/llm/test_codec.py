"""The batched Viterbi against a plain one, and exact round trips."""

import random
import time

import numpy as np

from corpusmill.llm import codec as C
from corpusmill.llm import pieces as P
from corpusmill.llm.common import table

ODD = [None, "", " ", "  two  spaces ", "a▁b ▁ c", "\n\nline\n", "🙂👍🏽 漢字", "\x00\x01 tab\t", "é" * 300, "x" * 2000, "The end"]


def best_score(text, c):
    """The greatest sum of scores over the whole text, position by position."""
    if not text:
        return 0.0
    marked = [C.MARK, *(C.FOREIGN if ch == P.SPACE else C.MARK if ch == " " else ord(ch) for ch in text)]
    index = {tuple(map(ord, t)): i for i, t in enumerate(c.table.texts)}
    best = [0.0] + [-np.inf] * len(marked)
    for j in range(1, len(marked) + 1):
        for n in range(1, min(c.table.longest, j) + 1):
            i = index.get(tuple(marked[j - n : j]))
            if i is not None:
                best[j] = max(best[j], best[j - n] + c.score[i])
            elif n == 1:
                ch = P.SPACE if marked[j - 1] == C.FOREIGN else chr(marked[j - 1])
                best[j] = max(best[j], best[j - 1] + C.BYTE * len(ch.encode()))
    return best[-1]


def score_of(ids, c):
    where = {int(i): k for k, i in enumerate(c.ids)}
    return sum(c.score[where[i]] if i in where else C.BYTE for i in ids.tolist())


def test_segmentations_are_best_and_decode_exactly(spark, sf_dir):
    c = C.codec()
    texts = [t or "" for t in ODD] + [r.text for r in table(spark, sf_dir, "documents").select("text").collect()]
    ids, offs = c.encode(texts)
    assert [b.decode() for b in c.decode(ids, offs)] == texts
    rng = random.Random(3)
    for i in [*range(len(ODD)), *rng.sample(range(len(ODD), len(texts)), 12)]:
        assert np.isclose(score_of(ids[offs[i] : offs[i + 1]], c), best_score(texts[i], c)), texts[i][:60]


def test_long_units_are_segmented_as_short_ones(monkeypatch):
    c = C.Codec()
    rng = random.Random(8)
    words = ["".join(rng.choices("theandrstin é漢▁", k=n)).replace(" ", "") for n in (1, 2, 17, 40, 300, 900)] + ["a" * 700, "ab" * 333]
    plain, offs = c.encode(words)
    monkeypatch.setattr(C, "LONG", 0)
    for chunk in (P.CHUNK, 61):
        monkeypatch.setattr(P, "CHUNK", chunk)
        d = C.Codec()
        ids, offs2 = d.encode(words)
        assert offs.tolist() == offs2.tolist() and (ids == plain).all()


def test_an_unbroken_text_takes_seconds():
    c, text = C.Codec(), "thequickbrownfox漢" * 60_000
    t = time.time()
    ids, offs = c.encode([text])
    assert c.decode(ids, offs) == [text.encode()] and time.time() - t < 30


def test_operators_on_odd_rows(spark):
    df = spark.createDataFrame([*enumerate(ODD), (1, "again"), (1, "again"), (None, "no id")], "doc_id long, text string").selectExpr("*", "1 as ids", "2 as n_pieces")
    rows = C.digest(df).collect()
    assert len(rows) == len(ODD) + 3 and all(r.round_trip for r in rows)
    back = C.decode(C.encode(df)).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r.doc_id), r.text or "") for r in df.collect())
    assert C.digest(df.limit(0)).count() == 0
