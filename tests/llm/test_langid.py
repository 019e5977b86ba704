"""Language identification: the forward algorithm against an enumeration, held-out accuracy, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import langid
from corpusmill.llm import pieces as P
from corpusmill.llm.common import table


def segmentations(word, table, p):
    if not word:
        return 1.0
    total = 0.0
    for n in range(1, len(word) + 1):
        if word[:n] in table:
            total += p[table[word[:n]] + 1] * segmentations(word[n:], table, p)
        elif n == 1:
            total += p[0] * segmentations(word[1:], table, p)
    return total


def test_forward_sums_all_segmentations():
    table = P.Pieces(["a", "b", "ab", "ba", "aba", "▁a", "▁"])
    rng = np.random.default_rng(1)
    p = rng.uniform(0.01, 0.3, (2, 8))
    index = {t: i for i, t in enumerate(table.texts)}
    for word in ("▁abab", "▁acba", "▁zzzz", "▁aaab"):
        alpha = P.forward(table.lattice(P.codes_of([word])), p, len(word))
        for k in range(2):
            assert np.isclose(alpha[-1][k, 0], segmentations(word, index, p[k]))


def test_long_words_sum_all_segmentations(monkeypatch):
    table = P.Pieces(["a", "b", "ab", "ba", "aba", "▁a", "▁"])
    rng = np.random.default_rng(1)
    p = rng.uniform(0.01, 0.3, (2, 8))
    monkeypatch.setattr(P, "CHUNK", 37)
    for n in (1, 5, 36, 37, 38, 120, 200):
        codes = P.codes_of(["▁" + "".join(rng.choice(list("abz"), n))])
        alpha = P.forward(table.lattice(codes), p, n + 1)
        assert np.allclose(P.log_forward(table, codes[0], p), np.log(alpha[-1][:, 0]))


def test_long_and_unknown_words_tell_languages_apart(spark):
    counts = {"en": {"the": 50, "and": 30}, "xx": {"qo": 40, "zu": 40}}
    model = langid.learn(counts)
    words = ["qozu" * 500, "theand" * 500, "ξ" * 300]
    got = langid.log_scores(words, model)
    assert got[0, 1] > got[0, 0] and got[1, 0] > got[1, 1] and got[2, 0] < -2000


def test_a_rare_language_keeps_its_words(spark):
    rows = [(i, "the and of " + " ".join(f"w{chr(97 + i % 26)}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)), "en") for i in range(200)] + [(1000 + i, "бара килә тора", "tt") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, sample_words=20)
    assert model.languages == ["en", "tt"]
    got = {r.lang for r in langid.identify(docs, model, ["lang"]).where("lang_pred = 'tt'").collect()}
    assert got == {"tt"}


def test_expected_uses_match_an_enumeration():
    table = P.Pieces(["a", "b", "ab", "▁"])
    p = np.array([[1e-3, 0.3, 0.2, 0.4, 0.1]])
    used = P.expected(table.lattice(P.codes_of(["▁ab"])), p, 3, np.array([[5.0]]))[0]
    split, joined = 0.1 * 0.3 * 0.2, 0.1 * 0.4
    assert np.allclose(used, 5 * np.array([0, split, split, joined, split + joined]) / (split + joined))


@pytest.fixture(scope="module")
def scored(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    return docs, langid.fit(docs)


def test_held_out_accuracy(scored):
    docs, model = scored
    rows = langid.identify(docs, model, ["doc_id", "lang"]).where(langid.bucket("doc_id", 5) == 0).collect()
    known = [r for r in rows if r.lang_pred != "und"]
    assert len(known) >= 0.99 * len(rows)
    assert sum(r.lang == r.lang_pred for r in known) >= 0.98 * len(known)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, scored):
    _, model = scored
    rows = [(1, None, "de"), (2, "", None), (3, "12 ² !", None), (None, "the and of that with from", None), (5, "the " * 50_000, None), (5, "x" * 20_000, None)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, lang_pred string")
    got = langid.identify(df, model).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and [r.score for r in got[:3]] == [0.0] * 3
    assert got[3].lang_pred == got[4].lang_pred == "en" and got[5].lang_pred != "und"
    assert langid.identify(df.limit(0), model).count() == 0
    assert langid.fit(df.where(F.col("lang").isNull())) is None
    assert [r.lang_pred for r in langid.identify(df, None).collect()] == ["und"] * 6
