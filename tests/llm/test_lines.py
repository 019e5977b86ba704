"""Dropped lines against a plain count of keys."""

import random
from collections import defaultdict

import numpy as np
import pytest

from corpusmill.llm import lines as L

WS = "\x20\x09\x0a\x0b\x0c\x0d"


def brute(rows, least=20, copies=3):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    key = lambda line: line.strip(WS).translate(lower)
    found = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                found[key(line)].add(i)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in found.items() if len(ids) >= copies}
    out = []
    for i, text in rows:
        every = (text or "").split("\n")
        stay = [x for x in every if key(x) not in last or last[key(x)] == i]
        out.append((i, "\n".join(stay), len(every), len(every) - len(stay)))
    return sorted(out, key=repr)


def got(df, **kw):
    return sorted((tuple(r) for r in L.drop_repeated(df, **kw).select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({"row": df["doc_id"], "digest": df["text"], "h": df["text"], "gone": df["text"], "n_lines": df["text"]})


LINE = "All rights reserved by the Author"
ODD = [
    (1, f"{LINE}\nown line of the first document\n"), (2, f" {LINE.upper()}\t\r\nx\n{LINE}"), (3, f"{LINE}\n{LINE}\nkept twice as I am the last"), (4, None), (5, ""), (6, "\n\n"), (None, LINE), (None, f"{LINE} but other\n{LINE}"),
    (7, "É" * 20), (8, "é" * 20), (9, "É" * 20), (10, "é" * 19), (11, "é" * 19), (12, "é" * 19), (13, "É" * 20), (2, f"another row of document two\n{LINE}"), (1, f"{LINE}\nown line of the first document\n"),
    (14, " " + "a line with an odd space"), (15, " " + "a line with an odd space"), (16, " " + "a line with an odd space"), (17, "x" * 300_000), (18, "X" * 300_000), (19, " " + "x" * 300_000), (20, "two only, two only, two only"), (21, "two only, two only, two only"),
]


@pytest.mark.parametrize("copies", [2, 3])
def test_odd_rows(spark, copies):
    assert got(frame(spark, ODD), copies=copies) == brute(ODD, copies=copies)


def test_rows_that_only_null_ids_hold(spark):
    rows = [(None, LINE), (None, LINE + "\nx"), (1, LINE)]
    assert got(frame(spark, rows), copies=2) == brute(rows, copies=2)
    assert got(frame(spark, rows)) == brute(rows)


def test_empty_table(spark):
    assert got(frame(spark, [])) == []


@pytest.mark.parametrize("max_bits", [L.MAX_BITS, 1 << 12])
def test_hot_lines_and_a_full_filter(spark, max_bits):
    rng = random.Random(3)
    common = [f"a line that very many documents hold, number {i}" for i in range(40)]
    rows = [(i, "\n".join([common[0]] * (i % 2) + [rng.choice(common) if rng.random() < 0.3 else f"a line of its own {rng.random()}" for _ in range(12)])) for i in range(400)]
    assert got(frame(spark, rows).repartition(7), max_bits=max_bits) == brute(rows)


def test_filters_miss_nothing_and_suspect_little():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 1 << 63, 60_000, dtype=np.uint64)
    s = L.Segment()
    for part in np.split(np.concatenate([h, h[:5000]]), 50):
        s.take(part)
    assert np.isin(h[:5000], s.again).all() and len(s.again) < 5000 + 0.04 * len(h)
    b = s.twice(1 << 30)
    assert b.has(L.places(h[:5000])).all() and b.has(L.places(h[5000:])).mean() < 0.08
    assert s.twice(64).has(L.places(h)).all()
