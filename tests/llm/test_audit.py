"""The filter audit against counting each order plainly."""

from itertools import permutations

import pytest

from corpusmill.llm import audit as A


def brute(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    import re

    rows = []
    for i, text, lang in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t))}
        fails["E"] = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)
        mine = [x for x in labels if x[0] == i and i is not None]
        rows.append((lang or "", {k for k, v in fails.items() if v}, any(q == 1 for _, q, _ in mine), any(x == 1 for _, _, x in mine)))
    out = []
    for part in {r[0] for r in rows}:
        mine, made = [r for r in rows if r[0] == part], []
        for order in permutations("ABCDE"):
            left = mine
            for i, f in enumerate(order):
                hit, left = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                made.append((part, "".join(order), i + 1, len(left), len(hit), sum(f in r[1] for r in mine) - len(hit), sum(r[1] == {f} for r in mine), sum(r[2] for r in hit), sum(r[3] for r in hit)))
        total = {f: sum(m[4] for m in made if m[1][m[2] - 1] == f) for f in "ABCDE"}
        out += [(*m, total[m[1][m[2] - 1]]) for m in made]
    return sorted(out)


LONG = " ".join(f"w{i}" for i in range(150))
DOCS = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG, None), (3, LONG, "de"), (4, "WORD #1", "en"), (5, None, "en"), (6, "", ""), (7, "", None), (None, LONG, "en"), (None, LONG, "fr"),
    (8, "same " * 400, "de"), (9, "ÄÖ \x1c x | y", "de"), (9, "other words", "de"), (10, "A" * 50 + "é" * 451, "fr"), (11, "x" * 200_000, "fr"), (-5, "WORD #1", "fr"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (4, None, None), (4, 1, 0), (9, 1, 1), (None, 1, 1), (99, 1, 1), (11, 0, 0)]


def frames(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    return d.withColumns({"part": d["doc_id"], "mask": d["doc_id"], "good": d["text"], "n": d["text"]}), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("times", [1, 3])
def test_every_order_of_odd_rows(spark, times):
    docs, labels = DOCS * times, LABELS * times
    got = sorted(tuple(r) for r in A.interactions(*frames(spark, docs, labels)).select(*A.COLUMNS).collect())
    assert got == brute(docs, labels)


def test_empty_tables(spark):
    assert A.interactions(*frames(spark, [], LABELS)).collect() == []
    got = sorted(tuple(r) for r in A.interactions(*frames(spark, DOCS[:3], [])).select(*A.COLUMNS).collect())
    assert got == brute(DOCS[:3], [])


def test_swaps_visit_every_order_once():
    for n in (1, 2, 5, 6):
        order, seen = list(range(n)), [tuple(range(n))]
        for i in A.swaps(n):
            order[i], order[i + 1] = order[i + 1], order[i]
            seen.append(tuple(order))
        assert sorted(seen) == sorted(permutations(range(n)))


def test_a_hot_group_of_copies(spark):
    docs = [(i, LONG if i % 3 else f"{i} {LONG}", "en" if i % 2 else "de") for i in range(300)]
    assert sorted(tuple(r) for r in A.interactions(*frames(spark, docs, [])).select(*A.COLUMNS).collect()) == brute(docs, [])
