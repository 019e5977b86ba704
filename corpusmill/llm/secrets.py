"""Secrets in texts: fixed patterns, and random-looking strings by two character Markov models.

One model is trained on labelled random strings, the other on labelled ordinary
identifiers; a candidate string is a secret if its log-likelihood ratio per
character exceeds a threshold, which is set on other labelled samples so that
at most FALSE_SHARE of the ordinary ones pass. Random samples come from a
seeded generator; ordinary ones join words of a public vocabulary in the usual
styles (camelCase, snake_case, paths, numbers, runs).

Spans: kind:start:end in code points, the end exclusive. Base kinds are assign
(the whole assignment), access and hex; random is the model's, and stands only
where it overlaps no base span.
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import over_batches, tokenizer_path

# Fixed patterns.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more: shorter runs are dropped
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SAMPLES, FALSE_SHARE = 6_000, 0.0005
SMOOTH = 0.2


@dataclass
class Model:
    ratio: np.ndarray  # [before, after] log likelihood ratio; row len(ALPHABET) is the start
    threshold: float

    def score(self, text: str) -> float:
        """Log-likelihood ratio per character."""
        at = CODE[np.frombuffer(text.encode("ascii"), np.uint8)]
        return float(self.ratio[np.concatenate([[len(ALPHABET)], at[:-1]]), at].mean())


CODE = np.zeros(128, np.int64)
CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def random_sample(rng: random.Random) -> str:
    """A labelled random string: base64, base62, hex with upper case, or lower case with digits."""
    kind, n = rng.randrange(4), rng.randint(20, 64)
    letters = (ALPHABET[:64], ALPHABET[:62], "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz0123456789")[kind]
    return "".join(rng.choices(letters, k=n)) + ("=" * rng.randint(0, 2) if kind == 0 else "")


def ordinary_sample(rng: random.Random, words: list[str]) -> str:
    """A labelled ordinary string of 20 characters or more."""
    kind = rng.randrange(10)
    pick = lambda: rng.choice(words)
    if kind == 8:
        return rng.choice(ALPHABET[:62] + "=-_/+") * rng.randint(20, 60)
    if kind == 9:
        return "".join(str((rng.randrange(10) + i * rng.randrange(2)) % 10) for i in range(rng.randint(20, 30)))
    out = pick()
    while len(out) < 20:
        w = pick()
        out += {0: "_" + w, 1: "-" + w, 2: w.capitalize(), 3: "/" + w, 4: w, 5: w, 6: "_" + w.upper(), 7: "/" + w + str(rng.randrange(100))}[kind]
    return out.upper() if rng.random() < 0.15 else out.capitalize() if rng.random() < 0.15 else out


def transitions(samples: list[str]) -> np.ndarray:
    n = len(ALPHABET)
    counts = np.full((n + 1, n), SMOOTH)
    for s in samples:
        at = CODE[np.frombuffer(s.encode("ascii"), np.uint8)]
        np.add.at(counts, (np.concatenate([[n], at[:-1]]), at), 1)
    return np.log(counts / counts.sum(1, keepdims=True))


def train(rand: list[str], plain: list[str], check: list[str], false_share: float = FALSE_SHARE) -> Model:
    """From labelled random and ordinary strings; check holds other ordinary strings, for the threshold."""
    model = Model(transitions(rand) - transitions(plain), 0.0)
    found = np.sort([model.score(s) for s in check])
    model.threshold = max(0.05, float(found[min(len(found) - 1, int(np.ceil(len(found) * (1 - false_share))) - 1)]) + 0.05)
    return model


@lru_cache(maxsize=2)
def default_model(vocabulary: str = "word_bpe_49k.json", samples: int = SAMPLES, seed: int = 1) -> Model:
    from tokenizers import Tokenizer

    words = sorted(w[:-4] for w in Tokenizer.from_file(tokenizer_path(vocabulary)).get_vocab() if w.endswith("</w>") and w[:-4].isascii() and w[:-4].isalpha() and len(w) > 6)
    rng = random.Random(seed)
    rand = [random_sample(rng) for _ in range(samples)]
    plain = [ordinary_sample(rng, words) for _ in range(samples)]
    return train(rand, plain, [ordinary_sample(rng, words) for _ in range(samples)])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, by start, then kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def model_spans(text: str, base: list[tuple[int, int, int]], model: Model) -> list[tuple[int, int, int]]:
    """The candidates that overlap no base span (sorted by start) and score enough; candidates and spans are passed once."""
    out, i, reach = [], 0, 0  # reach: how far the base spans that begin before a candidate's end go
    for m in CANDIDATE.finditer(text):
        while i < len(base) and base[i][0] < m.end():
            reach = max(reach, base[i][2])
            i += 1
        if reach <= m.start() and model.score(m[0]) > model.threshold:
            out.append((m.start(), 3, m.end()))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex (base spans), base_sha256, spans, n_random.

    A null text counts as empty: no spans, and the digest of the empty string. Repeated rows and null ids stay.
    """
    model = model or default_model()
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS[:3]), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_random", pa.int64())])

    def run(cols, n):
        counts, shas, spans = np.zeros((4, n), np.int64), [], []
        for i, text in enumerate(cols["text"].to_pylist()):
            base = base_spans(text)
            more = model_spans(text, base, model)
            for _, k, _ in base + more:
                counts[k, i] += 1
            shas.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append(joined(base + more))
        return {"doc_id": cols["doc_id"], "base_sha256": shas, "spans": spans} | {f"n_{k}": counts[j] for j, k in enumerate(KINDS)}

    return over_batches(df, run, schema, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")
