"""The grammar's transducers on clauses, and held-out precision and recall."""

import pytest

from corpusmill.llm import toxicity as X
from corpusmill.llm.common import table

INSULTS = X.Insults({"idiot": 1.0, "scum": 0.5, "moro*": 0.25})


def named(text):
    return {X.EMITS[i]: v for i, v in enumerate(X.matches(text, INSULTS)) if v}


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("an idiot came by", {"insult": 1.0}),
        ("you are an idiot", {"aimed_insult": 1.0}),
        ("this is not an idiot", {"negated_insult": 1.0}),
        ("not here. idiot", {"insult": 1.0}),
        ("the paper said an idiot spoke. scum", {"reported_insult": 1.0, "insult": 0.5}),
        ("a scum idiot", {"insult": 0.5, "piled_insult": 1.0}),
        ("i will kill", {"vowed_threat": 1.0}),
        ("to kill time", {"threat": 1.0}),
        ("they may kill", {"aimed_threat": 1.0}),
        ("idiot here. idiot there. an idiot", {"insult": 3.0}),
        ("never hurt", {"negated_threat": 1.0}),
        ("plain words only, and moro", {}),
        ("a moronic plan", {"insult": 0.25}),
    ],
)
def test_clauses(text, found):
    assert named(text) == found


def test_composition_equals_running_in_turn():
    import random

    rng = random.Random(6)
    for _ in range(300):
        symbols = [rng.randrange(X.END + 1) for _ in range(30)]
        turn = symbols
        for t in X.PARTS:
            state, out = 0, []
            for s in turn:
                state, w = t.arcs[state][s]
                out.append(w)
            turn = out
        state, once = 0, []
        for s in symbols:
            state, w = X.GRAMMAR.arcs[state][s]
            once.append(w)
        assert once == turn


def test_negation_report_and_repeats_change_the_features():
    made = [tuple(X.features(t, INSULTS)) for t in ("here an idiot came", "not an idiot came", "it said an idiot came", "you idiot came", "here an idiot came. an idiot " * 5)]
    assert len(set(made)) == 5
    assert made[1][-2:] == made[2][-2:] == (0.0, 0.0)  # nothing strong, so no rate and no heaviest clause


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    return docs, labels, X.fit(docs, labels)


def test_held_out_precision_and_recall(fitted):
    docs, labels, model = fitted
    rows = X.score(docs.where(X.bucket("doc_id", 3) == 1), model).join(labels, "doc_id").collect()
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in rows)
    assert hit >= 0.9 * sum(r.toxic == 1 for r in rows)  # some rows marked toxic hold no insult at all
    assert hit >= 0.97 * sum(r.predicted == 1 for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_score_follows_the_clause(spark, fitted):
    _, _, model = fitted
    word = max((w for w in model.insults if not w.endswith("*")), key=model.insults.get)
    rows = [(1, f"here is {word}"), (2, f"here is not {word}"), (3, f"he wrote of {word}"), (4, f"you {word}")]
    got = {r.doc_id: r.score for r in X.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[1] > got[2] and got[1] > got[3] and got[4] >= got[2]


def test_odd_rows(spark, fitted):
    _, labels, model = fitted
    rows = [(1, None), (2, ""), (None, "you idiot"), (3, "word " * 50_000), (3, "moron idiot trash")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    got = X.score(df.drop("score"), model).collect()
    assert [r.predicted for r in got] == [0, 0, 1, 0, 1]
    empty = X.fit(df.limit(0), labels)
    assert empty.insults == {} and X.score(df, empty).count() == 5
    assert X.score(df.limit(0), model).count() == 0
    same = spark.createDataFrame([(1, 1), (1, None), (None, 1)], "doc_id long, toxic int")
    assert X.fit(df, same).insults == {}
