"""Near copies by five-word similarity against all pairs."""

import random

from test_simhash import expected

import corpus_pipeline as P
from corpusmill.llm import resemble
from corpusmill.llm.common import table


def shingled(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def stay(rows):
    """Ids in order, less those similar to an earlier one that stays."""
    out, held = [], []
    for i, t in sorted(rows):
        s = shingled(t)
        if not any(5 * len(s & x) >= 4 * len(s | x) for x in held):
            out.append(i)
            held.append(s)
    return out


def plain_stage(rows):
    firsts = {c for _, _, c in expected(rows)}
    return stay([(i, t) for i, t in rows if i in firsts])


def test_stage_keeps_what_all_pairs_keep(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(r.doc_id for r in P.drop_near_duplicates(spark, docs, "").collect()) == plain_stage(rows)


def test_similar_texts_go_in_order_of_id(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    texts = [base]
    for step in range(6):  # each is an edit of the last; the similarity to the first falls below 0.8
        t = list(texts[-1])
        for at in range(step * 60, step * 60 + 60, 12):
            t[at] = f"x{step}{at}"
        texts.append(t)
    texts += [base[:200] + [f"y{k}"] + base[201:] for k in range(80)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = stay(rows)
    assert 1 < len(want) < 7
    for large in (5000, 3):
        assert sorted(r.doc_id for r in resemble.kept(df, large=large).collect()) == want
    some = [r for r in rows if r[0] % 3]
    assert sorted(r.doc_id for r in resemble.kept(df, df.where("doc_id % 3 <> 0").select("doc_id")).collect()) == stay(some)


def test_rounds_follow_the_blocks_where_bands_are_shared_and_nothing_is_similar(spark, monkeypatch):
    rng, real, cuts = random.Random(4), resemble.cut, []
    common = [f"c{k}" for k in range(60)]
    rows = [(i, " ".join(common + [f"w{rng.randrange(10**9)}" for _ in range(24)] + ["end"] * (i % 2))) for i in range(60)]  # similarity about 0.54
    rows += [(100 + i, rows[i][1] + f" z{i}") for i in range(0, 60, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").cache()
    monkeypatch.setattr(resemble, "cut", lambda d: cuts.append(1) or real(d))
    want = stay(rows)
    assert want == list(range(60))
    assert sorted(r.doc_id for r in resemble.kept(df, large=20).collect()) == want
    assert len(cuts) <= 6 + 2 + 2 * 4
