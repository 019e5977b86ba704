"""Language identification by segmentation-marginalised unigrams over a fixed public vocabulary.

Each language has a probability for each piece of the vocabulary. A word's
probability is the sum over all its segmentations into pieces, by a forward
algorithm; a text's score for a language is the sum of its words' log
probabilities. Piece probabilities are learned by expectation maximisation from
the words of a bounded sample of labelled documents.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import pieces as P
from .common import blocks, frugal, share, sole, trim

#: Documents that a language's model is learned from, about; words that all languages learn from, shared alike, and the
#: words that each of them gets at least.
SAMPLE_DOCS, SAMPLE_WORDS, LEAST_WORDS = 3_000, 40_000, 500
#: Rounds of expectation maximisation; what each piece has besides its uses; a character that is no piece.
ROUNDS, PRIOR, UNKNOWN = 3, 0.02, 1e-7
#: A longer word is scored in blocks, with scaled sums; it teaches nothing.
LONGEST = 40
#: Words, and their letters, that a worker remembers before it starts anew.
REMEMBER, REMEMBER_CHARS = 250_000, 4 << 20
UND = "und"
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    languages: list[str]
    p: np.ndarray  # [language, piece + 1]
    vocabulary: str
    uid: str = field(default_factory=lambda: uuid.uuid4().hex)


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    return WORD.findall(text.lower())


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def lettered(docs: DataFrame) -> DataFrame:
    """Rows whose text has a letter."""

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([has_letter(t.as_py()) for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def log_scores(words: list[str], model: Model) -> np.ndarray:
    """[word, language]: log probability of the word, marked as a word's beginning, over all segmentations."""
    table = P.pieces(model.vocabulary)
    out = np.zeros((len(words), len(model.languages)))
    marked = [P.SPACE + w for w in words]
    for at, some in P.by_length(marked):
        n = len(some[0])
        if n > LONGEST:
            for i, codes in zip(at.tolist(), P.codes_of(some)):
                out[i] = P.log_forward(table, codes, model.p)
            continue
        alpha = P.forward(table.lattice(P.codes_of(some)), model.p, n)
        out[at] = np.log(np.maximum(alpha[n].T, 1e-300))
    return out


def learn(counts: dict[str, dict[str, int]], vocabulary: str = "piece_bpe_32k.model", rounds: int = ROUNDS) -> Model:
    """counts[language][word]."""
    table = P.pieces(vocabulary)
    languages = sorted(counts)
    words = sorted({w for c in counts.values() for w in c})
    weight = np.array([[counts[k].get(w, 0) for w in words] for k in languages], np.float64).reshape(len(languages), len(words))
    size = len(table.texts)
    p = np.tile(1.0 / (np.arange(size) + 10.0), (len(languages), 1))
    p = np.concatenate([np.full((len(languages), 1), UNKNOWN), p / p.sum(1, keepdims=True)], axis=1)
    groups = [(at, len(some[0]), table.lattice(P.codes_of(some))) for at, some in P.by_length([P.SPACE + w for w in words])]
    for _ in range(rounds):
        used = np.zeros_like(p)
        for at, n, lattice in groups:
            used += P.expected(lattice, p, n, weight[:, at])
        used = used[:, 1:] + PRIOR
        p[:, 1:] = used / used.sum(1, keepdims=True)
    return Model(languages, p, vocabulary)


def fit(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS) -> Model | None:
    """A model from documents whose crc32(doc_id) mod 5 is not 0 and whose lang is not null; None if there are none.

    Each language gives about sample_docs documents, chosen by a hash of doc_id, and its commonest words of up to LONGEST
    letters: sample_words shared by the languages alike, or LEAST_WORDS each if that is more.
    """
    train = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (bucket("doc_id", 5) != 0)).select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    found = {r.lang: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not found:
        return None
    chosen = None
    for k, n in sorted(found.items()):
        mine = (F.col("lang") == k) & share("langid", sample_docs, n, "doc_id")
        chosen = mine if chosen is None else chosen | mine
    words = train.where(chosen).select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))).alias("word")).where(F.length("word") < LONGEST)
    counted = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    most = max(LEAST_WORDS, sample_words // len(found))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    counts: dict[str, dict[str, int]] = {}
    for r in counted.withColumn("r", rank).where(F.col("r") <= most).collect():  # bounded by `most` a language
        counts.setdefault(r.lang, {})[r.word] = r["n"]
    return learn(counts, vocabulary) if counts else None


def bucket(column: str, n: int):
    """crc32 of a column as text, modulo n; a null column counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


class Scorer:
    """Scores texts in one worker, remembering words."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.table, self.n = np.empty((1 << 14, len(self.model.languages)), np.float32), 0

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """[text, language]: log probability; rows of texts without letters are zero."""
        if len(self.index) > REMEMBER or self.chars > REMEMBER_CHARS:
            self.forget()
        words = [words_of(t) if t else [] for t in texts]
        new = list(set().union(*words) - self.index.keys()) if words else []
        if new:
            self.table = np.concatenate([self.table[: self.n], log_scores(new, self.model).astype(np.float32)])
            self.index.update(zip(new, range(self.n, self.n + len(new))))
            self.n += len(new)
            self.chars += sum(map(len, new))
        out = np.zeros((len(texts), len(self.model.languages)))
        counts = np.fromiter(map(len, words), np.int64, len(words))
        index = self.index
        at = np.fromiter(map(index.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        some = np.flatnonzero(counts)
        if len(some):
            starts = (np.cumsum(counts) - counts)[some]
            for k in range(out.shape[1]):
                out[some, k] = np.add.reduceat(self.table[at, k].astype(np.float64), starts)
        return out


def identify(docs: DataFrame, model: Model | None, carry: list[str] | None = None, id_col: str = "doc_id") -> DataFrame:
    """carry (doc_id alone if not given), lang_pred and score for every document.

    score is the probability of lang_pred among the model's languages, all as likely before; it is 0 for `und`, which
    texts that are null or have no letter get, and all texts where there is no model. Ties go to the language that
    sorts first.
    """
    carry = carry or [id_col]
    df = docs.select(*carry, F.col("text").cast("string").alias("__text"))
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)
    schema = [(f.name, f.dataType.simpleString()) for f in docs.select(*carry).schema]
    names = df.columns

    def run(batches):
        frugal()
        model = held.value
        scorer = sole(("langid", model.uid), lambda: Scorer(model)) if model is not None else None
        for batch in batches:
            for part in blocks(batch, "__text"):
                texts = part.column(len(names) - 1).to_pylist()
                pred, score = [UND] * len(texts), np.zeros(len(texts))
                if model is not None and texts:
                    ll = scorer(texts)
                    best = ll.argmax(1)
                    score = 1 / np.exp(ll - ll.max(1, keepdims=True)).sum(1)
                    pred = [model.languages[b] if has_letter(t) else UND for b, t in zip(best.tolist(), texts)]
                    score = np.where([x == UND for x in pred], 0.0, score)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=[*names[:-1], "lang_pred", "score"])
        trim()

    return df.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in schema) + ", lang_pred string, score double")
