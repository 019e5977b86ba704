"""Packing: ids against the tokenizer text by text, and the laws of a packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from corpusmill.llm import packing
from corpusmill.llm.common import table

ODD = [None, "", " ", "\n\n", "It's 3.14, isn't it?! <|endoftext|> x", "STRASSE Straße ẞ İstanbul ΑΣ. ﬁ ①", "é é, a b\x1cc d", "x" * 3000, "'s 't word's. don't.", "🙂👍🏽!!", "été. ÉTÉ, Été;"]


def ids_of(text):
    tok = packing.word_cache("word_bpe_49k.json").tokenizer
    return [*tok.encode(text or "", add_special_tokens=False).ids, 1]


def test_words_give_the_ids_of_texts(sf_dir, spark):
    texts = [t or "" for t in ODD] + [r.text for r in table(spark, sf_dir, "documents").select("text").collect()]
    ids, offs = packing.word_cache("word_bpe_49k.json").encode(texts)
    for i, t in enumerate(texts):
        assert ids[offs[i] : offs[i + 1]].tolist() == ids_of(t)[:-1], t[:80]


def lawful(rows, docs, capacity):
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, text in docs:
        ids = ids_of(text)
        got = sorted(pieces[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in got] == [(k, s, min(capacity, len(ids) - s)) for k, s in enumerate(range(0, len(ids), capacity))]
        assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in got]
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_documents_are_packed_whole_and_tight(spark, sf_dir, capacity):
    df = table(spark, sf_dir, "documents")
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()] + [(10**6 + i, t) for i, t in enumerate(ODD)]
    rows = packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string"), capacity=capacity).collect()
    used = lawful(rows, docs, capacity)
    assert used <= 1.03 * sum(r.length for r in rows) / capacity + 2


def test_repeats_nulls_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c", 5), (1, "a b c", 5), (None, None, 5)], "doc_id long, text string, length int")
    rows = packing.pack_documents(df).collect()
    assert sorted((str(r.doc_id), r.length) for r in rows) == [("1", 4), ("1", 4), ("None", 1)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3
    assert packing.pack_documents(df.limit(0)).count() == 0


def test_plan_places_every_piece_once():
    rng = random.Random(4)
    for hist in ({4096: 3}, {1: 5}, {4095: 2, 1: 1}, {k: rng.randint(1, 900) for k in rng.sample(range(1, 4097), 400)}):
        made = packing.plan(hist)
        assert made.used == hist
        fill = defaultdict(int)
        for length, rows in made.rows.items():
            assert rows[0][0] == 0 and all(a[1] == b[0] for a, b in zip(rows, rows[1:]))
            for lo, hi, n, first, _ in rows:
                for s in range(first, first + (hi - lo) // n):
                    fill[s] += n * length
        assert len(fill) == made.sequences and max(fill.values()) <= 4096
        assert made.sequences <= sum(k * v for k, v in hist.items()) / 4096 * 1.02 + 2


def test_the_programme_is_no_worse_than_best_fit_alone():
    rng = np.random.default_rng(7)
    made = {"long": rng.integers(1000, 2500, 5000), "thirds": rng.integers(1300, 1500, 3000), "mixed": np.concatenate([rng.integers(2, 900, 8000), rng.integers(900, 4096, 1500)])}
    for name, lengths in made.items():
        hist = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
        alone = sum(t for _, t in packing.best_fit(dict(hist), 4096))
        used = packing.plan(hist).sequences
        assert used <= alone and (name == "mixed" or used < alone)


def test_knapsack_is_best():
    rng = np.random.default_rng(5)
    for _ in range(20):
        sizes = np.sort(rng.choice(np.arange(2, 15), 4, replace=False))
        price = rng.uniform(0, 1, 4)
        best = np.zeros(31)
        for c in range(1, 31):
            best[c] = max([best[c - 1], *(best[c - s] + p for s, p in zip(sizes, price) if s <= c)])
        config = packing.dearest(price, sizes, np.full(4, 99), 30)
        assert sum(sizes[i] * n for i, n in config.items()) <= 30
        assert np.isclose(sum(price[i] * n for i, n in config.items()), best[30])
