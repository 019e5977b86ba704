"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols (insult, threat, target, negation, report verb, intent,
other, clause end). Five transducers rewrite the symbol string: of insults, one
that follows another is piled on; of threats, one soon after an intent is vowed;
a negation weakens insults and threats in its scope, a report verb does so to
the clause's end, and a target strengthens those close to it. Their composition
is a single table of states, so a text is read once. What it emits are matches
inside clauses (insult, aimed insult, negated insult, ...), and a document's
score is a logistic function of the weights of its matched clauses alone: a word
that no clause matches counts for nothing.

Threats, intents, targets, negations and report verbs are fixed short lists.
Insults are learned from labelled documents: words and stems whose contexts (the words on
both sides) are far more varied in toxic documents than in clean ones. Contexts
and not occurrences count, so the words of one much-copied document don't pass.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, cut, frugal, share, sole, trim

#: Symbols of words, then what transducers write.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, INTENT, END = range(8)
PILED, VOWED, NEGATED_INSULT, NEGATED_THREAT, REPORTED_INSULT, REPORTED_THREAT, AIMED_INSULT, AIMED_THREAT = range(8, 16)
SYMBOLS = 16
#: Labelled documents that the model is learned from, about.
SAMPLE = 12_000
#: An insult has this many different contexts in toxic documents at least, and this log odds.
CONTEXTS, ODDS, SHRINK = 5, 2.0, 15.0
#: Insults are whole words and stems of so many letters.
STEMS = (4, 5, 6, 7, 8)
CUT = 0.7

# Fixed word lists.
THREATS = "kill hurt destroy murder beat stab shoot burn crush töten umbringen verprügeln tuer frapper détruire matar golpear destruir".split()
INTENTS = "will ll gonna going shall must should werde werden wirst vais va allons voy vas vamos".split()
TARGETS = "you your yours yourself he she him her they them du dich dir ihr euch tu toi te vous ils elles tú ti usted ustedes ellos ellas".split()
NEGATIONS = "not no never neither nor isn aren wasn don doesn nicht kein keine nie pas jamais aucun nunca ningún jamás".split()
REPORTS = "said says say told wrote writes called calls quoted quote claimed sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó".split()

#: What the grammar emits, in the order of a document's features.
EMITS = ["insult", "piled_insult", "aimed_insult", "negated_insult", "reported_insult", "threat", "vowed_threat", "aimed_threat", "negated_threat", "reported_threat"]
MATCH = dict(zip([INSULT, PILED, AIMED_INSULT, NEGATED_INSULT, REPORTED_INSULT, THREAT, VOWED, AIMED_THREAT, NEGATED_THREAT, REPORTED_THREAT], range(len(EMITS))))
#: Matches at full strength.
STRONG = [k for k, name in enumerate(EMITS) if not name.startswith(("negated", "reported"))]
N_FEATURES = len(EMITS) + 2


@dataclass
class Transducer:
    """arcs[state][symbol] = (next state, symbol written). State 0 is the start; all states accept."""

    arcs: list[list[tuple[int, int]]]


def scope(opener: int, reach: int | None, rewrites: dict[int, int]) -> Transducer:
    """Rewrites symbols within reach words after an opener (None: as far as the clause goes). A clause's end closes it."""
    arcs = []
    for state in range((1 if reach is None else reach) + 1):
        row = []
        for symbol in range(SYMBOLS):
            after = 0 if symbol == END else state if reach is None else max(state - 1, 0)
            if symbol == opener:
                after = 1 if reach is None else reach
            row.append((after, rewrites.get(symbol, symbol) if state else symbol))
        arcs.append(row)
    return Transducer(arcs)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that reads what first writes; states are the reachable pairs."""
    index, todo, arcs = {(0, 0): 0}, [(0, 0)], []
    for a, b in todo:
        row = []
        for to_a, written in first.arcs[a]:
            to_b, out = second.arcs[b][written]
            if (to_a, to_b) not in index:
                index[to_a, to_b] = len(todo)
                todo.append((to_a, to_b))
            row.append((index[to_a, to_b], out))
        arcs.append(row)
    return Transducer(arcs)


def both(insult: int, threat: int) -> dict[int, int]:
    return {INSULT: insult, PILED: insult, THREAT: threat, VOWED: threat}


PARTS = [
    scope(INSULT, 1, {INSULT: PILED}),
    scope(INTENT, 3, {THREAT: VOWED}),
    scope(NEGATION, 3, both(NEGATED_INSULT, NEGATED_THREAT)),
    scope(REPORT, None, both(REPORTED_INSULT, REPORTED_THREAT)),
    scope(TARGET, 4, both(AIMED_INSULT, AIMED_THREAT)),
]
GRAMMAR = PARTS[0]
for _part in PARTS[1:]:
    GRAMMAR = compose(GRAMMAR, _part)
TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]")
LETTERS = re.compile(r"[^\W\d_]+")
CLASSES = {w: k for k, ws in ((THREAT, THREATS), (INTENT, INTENTS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws} | dict.fromkeys(".!?;\n", END)


@dataclass
class Model:
    insults: dict[str, float]  # word, or stem and an asterisk: weight, its shrunk log odds
    weights: np.ndarray  # constant, then one for each of features()
    uid: str = field(default_factory=lambda: uuid.uuid4().hex)


class Insults:
    """The transducer from words to insults: whole words, and stems with any ending; the weightiest that fits counts."""

    def __init__(self, insults: dict[str, float]):
        self.whole = {w: x for w, x in insults.items() if not w.endswith("*")}
        self.stems = {w[:-1]: x for w, x in insults.items() if w.endswith("*")}
        self.sizes = sorted({len(w) for w in self.stems})
        self.heads = {w[: STEMS[0]] for w in self.stems}

    def get(self, word: str) -> float | None:
        found = self.whole.get(word)
        if word[: STEMS[0]] in self.heads:
            for n in self.sizes:
                if n < len(word) and (x := self.stems.get(word[:n])) is not None and (found is None or x > found):
                    found = x
        return found

    def any_in(self, words: list[str]) -> bool:
        some = set(words)
        if not (some.isdisjoint(self.whole) and some.isdisjoint(THREATS)):
            return True
        return bool(self.heads) and any(self.get(w) is not None for w in some if w[: STEMS[0]] in self.heads)


def clauses(text: str, insults: Insults) -> tuple[list[np.ndarray], int]:
    """(the weights of each clause that has a match, by EMITS; how many clauses have words)."""
    found, now, words, n = [], None, 0, 0
    state, arcs, classes, match = 0, GRAMMAR.arcs, CLASSES, MATCH
    for token in TOKEN.findall(text):
        weight = insults.get(token)
        symbol = INSULT if weight is not None else classes.get(token, OTHER)
        state, written = arcs[state][symbol]
        if symbol == END:
            if now is not None:
                found.append(now)
            now, n, words = None, n + (words > 0), 0
            continue
        words += 1
        if symbol in (INSULT, THREAT):
            if now is None:
                now = np.zeros(len(EMITS))
            now[match[written]] += 1.0 if weight is None else weight
    if now is not None:
        found.append(now)
    return found, n + (words > 0)


def matches(text: str, insults: Insults) -> np.ndarray:
    """Summed weights of all matches of all clauses, by EMITS."""
    found, _ = clauses(text, insults)
    return np.sum(found, axis=0) if found else np.zeros(len(EMITS))


def features(text: str | None, insults: Insults) -> np.ndarray:
    """Of the matched clauses: log1p of the weights by EMITS, log1p of the strong ones' weight in a hundred clauses, and
    that of the clause with most."""
    low = (text or "").lower()
    if not insults.any_in(LETTERS.findall(low)):
        return np.zeros(N_FEATURES)
    found, n = clauses(low, insults)
    strong = np.array([c[STRONG].sum() for c in found])
    return np.concatenate([np.log1p(np.sum(found, axis=0)), [np.log1p(100 * strong.sum() / max(n, 1)), np.log1p(strong.max())]])


def logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, penalty: float = 0.5, rounds: int = 200) -> np.ndarray:
    """Weights by Newton's method on those not held at zero; the constant, first, isn't penalised, and matches never lower a score.

    times: how often each row counts.
    """
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    ridge = penalty * np.r_[0.0, np.ones(x.shape[1] - 1)]

    def loss(w):
        z = x @ w
        return (times * (np.logaddexp(0, z) - y * z)).sum() + (ridge * w * w).sum() / 2

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (times * (p - y)) + ridge * w
        free = np.flatnonzero((np.arange(len(w)) == 0) | (w > 0) | (g < 0))
        h = (x[:, free].T * (times * np.maximum(p * (1 - p), 1e-6))) @ x[:, free] + np.diag(ridge[free] + 1e-6)
        step, size = np.zeros(len(w)), 1.0
        step[free] = np.linalg.solve(h, g[free])
        while size > 1e-6:
            new = w - size * step
            new[1:] = np.maximum(new[1:], 0)
            if (then := loss(new)) < now:
                break
            size /= 2
        else:
            break
        done = now - then < 1e-7 * max(1.0, now)
        w, now = new, then
        if done:
            break
    return w


def bucket(column: str, n: int):
    """crc32 of a column as text, modulo n; a null column counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from labelled documents whose crc32(doc_id) mod 3 is not 1: about sample of them, by a hash of doc_id.

    Without toxic labels the model has no insults and threats alone raise its scores.
    """
    ours = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (bucket("doc_id", 3) != 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = ours.count()
    chosen = ours.where(share("toxicity", sample, max(total, 1), "doc_id"))
    train = docs.select("doc_id", F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text")).join(F.broadcast(chosen), "doc_id")  # at most about `sample` rows of two numbers
    train = cut(train.select("text", F.col("toxic").cast("int").alias("toxic")))  # the sample is read three times, documents once
    insults = lexicon(train)
    held = docs.sparkSession.sparkContext.broadcast(insults)
    n = N_FEATURES

    def run(batches):
        sole("toxicity", lambda: None)
        frugal()
        known = Insults(held.value)
        for batch in batches:
            for part in blocks(batch, "text"):
                rows = [features(t, known) for t in part.column(0).to_pylist()]
                flat = np.concatenate(rows) if rows else np.empty(0)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * n), pa.array(flat))], names=["toxic", "x"])

    grouped = train.mapInArrow(run, "toxic int, x array<double>").groupBy("toxic", "x").agg(F.count("*").alias("n")).collect()
    x = np.array([r.x for r in grouped]).reshape(-1, n)
    y = np.array([r.toxic for r in grouped], np.float64)
    times = np.array([r["n"] for r in grouped], np.float64)
    if not len(y) or y.min() == y.max():
        return Model(insults, np.r_[-3.0, np.ones(n)])
    return Model(insults, logistic(x, y, times))


def lexicon(train: DataFrame, contexts: int = CONTEXTS, odds: float = ODDS) -> dict[str, float]:
    """{insult: weight} from (text, toxic); texts are lower-cased.

    A context is credited to one text alone, so an insult's contexts come from `contexts` texts at least. Its log odds
    are shrunk by SHRINK: a word of few texts, such as those of one family of near copies, weighs little.
    """
    tokens = train.select("toxic", F.xxhash64("text").alias("d"), F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), F.lit(1)).alias("w"))
    around = F.expr("transform(w, (x, i) -> struct(x as w, xxhash64(if(i > 0, w[i - 1], ''), if(i + 1 < size(w), w[i + 1], '')) as c))")
    each = tokens.select("toxic", "d", F.explode(around).alias("t")).select("toxic", "d", "t.w", "t.c")
    seen = each.groupBy("toxic", "w", "c").agg(F.min("d").alias("d"))
    bad = F.col("toxic") == 1
    words = seen.groupBy("w").agg(F.count_if(bad).alias("t"), F.count_if(~bad).alias("n"), F.collect_set(F.when(bad, F.col("d"))).alias("d"))  # texts of the sample at most
    units = F.expr(f"concat(array(w), transform(filter(array{STEMS}, k -> k < length(w)), k -> concat(left(w, k), '*')))")
    counted = words.select(F.explode(units).alias("w"), "t", "n", "d").groupBy("w").agg(F.sum("t").alias("t"), F.sum("n").alias("n"), F.size(F.array_distinct(F.flatten(F.collect_list("d")))).alias("texts"))
    totals = each.groupBy("toxic").count().collect()
    of = {r.toxic: r["count"] for r in totals}
    if not of.get(1):
        return {}
    score = F.log((F.col("t") + 0.5) / of[1]) - F.log((F.col("n") + 0.5) / max(of.get(0, 0), 1))
    rows = counted.where(F.col("texts") >= contexts).withColumn("o", score * F.col("texts") / (F.col("texts") + SHRINK)).where(F.col("o") >= odds).collect()  # words that the sample's toxic documents use in many ways
    return {r.w: r.o for r in rows if r.w not in CLASSES}


def score(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """carry (doc_id alone if not given), score (0 to 1) and predicted (1 from CUT up) for every document; null and empty texts too."""
    carry = carry or ["doc_id"]
    df = docs.select(*carry, F.col("text").cast("string").alias("__text"))
    schema = [(f.name, f.dataType.simpleString()) for f in docs.select(*carry).schema]
    names = df.columns
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        frugal()
        model = sole(("toxicity", held.value.uid), lambda: held.value)
        known = Insults(model.insults)
        for batch in batches:
            for part in blocks(batch, "__text"):
                x = np.array([features(t, known) for t in part.column(len(names) - 1).to_pylist()]).reshape(-1, N_FEATURES)
                p = 1 / (1 + np.exp(-np.clip(model.weights[0] + x @ model.weights[1:], -30, 30)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(p), pa.array((p >= CUT).astype(np.int32))], names=[*names[:-1], "score", "predicted"])
        trim()

    return df.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in schema) + ", score double, predicted int")
