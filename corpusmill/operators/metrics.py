"""Measures: counts, purity, strategy scores, verdicts, overlaps of words."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.text import share, tokens
from .ranks import exact_medians


def counts(df: DataFrame, group: list[str], text: str = "text") -> DataFrame:
    """By group: docs, chars, tokens, tokens_per_doc."""
    t = F.col(text)
    out = df.groupBy(*group).agg(F.count("*").alias("docs"), F.sum(F.length(t)).alias("chars"), F.sum(F.size(tokens(t))).alias("tokens"))
    return out.withColumn("tokens_per_doc", F.round(F.col("tokens") / F.col("docs"), 1))


#: Words whose numbers of ids a worker remembers before it starts anew, and how many texts it splits at once.
MOST_WORDS, TEXTS = 600_000, 512


#: The kind of file that is known to make ids of runs of letters, single digits and runs of other characters, each by itself,
#: never of white space, and in lower case. MARKS never join with letters there.
BY_RUNS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
    "truncation": None, "padding": None,
}
MARKS = ".,!?;:#*&%$"


def splits_at_space(tokenizer) -> bool:
    """Whether a text has as many ids as its words have. Files of the kind above are known for it, no others are taken to be so."""
    made = json.loads(tokenizer.to_str())
    added = (t for t in made.get("added_tokens", []))
    apart = all(t["content"].startswith("<|") and t["content"].endswith("|>") and not re.search(r"\s", t["content"]) and not t["normalized"] for t in added)
    return apart and made["model"]["type"] == "BPE" and not made["model"].get("dropout") and all(made.get(k) == v for k, v in BY_RUNS.items())


def lengths_by_words(texts: list[str], memory: dict[str, int], encode) -> np.ndarray:
    """How many ids each text has, by its words; new words are encoded once and remembered."""
    words = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))]).astype(np.int64)
    numbered = words.flatten().dictionary_encode()
    distinct = numbered.dictionary.to_pylist()
    new = [w for w in distinct if w not in memory]
    halves = []
    for w in new:
        n = len(w.rstrip(MARKS))
        halves.append((w[:n].lower() if w[:n].isascii() else w[:n], w[n:]) if w[:n].isalpha() else (w, ""))
    missing = list({h for pair in halves for h in pair if h not in memory})
    for i in range(0, len(missing), 8192):
        memory.update(zip(missing[i : i + 8192], (len(e.ids) for e in encode(missing[i : i + 8192]))))
    memory.update((w, memory[x] + memory[y]) for w, (x, y) in zip(new, halves))
    each = np.array([memory[w] for w in distinct], np.int64)[numbered.indices.to_numpy(zero_copy_only=False)]
    return np.diff(np.concatenate([[0], np.cumsum(each)])[ends])


def tokenizer_length(text: Column | str, path: str, batch: int = TEXTS) -> Column:
    """How many ids a tokenizer's file makes of a text, without special ones; null counts as empty.

    By distinct words where the tokenizer allows it, else text by text, in either case without offsets.
    """

    def run(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        encode = lambda some: made.encode_batch_fast(some, add_special_tokens=False)
        by_words, memory = splits_at_space(made), {}
        for s in frames:
            filled, out = s.fillna("").tolist(), []
            for i in range(0, len(filled), batch):
                some = filled[i : i + batch]
                if by_words:
                    out.extend(lengths_by_words(some, memory, encode).tolist())
                    if len(memory) > MOST_WORDS:
                        memory.clear()
                else:
                    out.extend(len(e.ids) for e in encode(some))
            yield pd.Series(out, dtype="int64")

    run.__annotations__ = {"frames": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "long")(text)


def tokenizer_counts(df: DataFrame, group: list[str], path: str, name: str = "tokens", text: str = "text") -> DataFrame:
    """By group: docs, chars and the tokens of a tokenizer's file, and tokens_per_doc."""
    rows = df.select(*group, F.length(text).alias("__c"), tokenizer_length(text, path).alias("__t"))
    out = rows.groupBy(*group).agg(F.count("*").alias("docs"), F.sum("__c").alias("chars"), F.sum("__t").alias(name))
    return out.withColumn("tokens_per_doc", F.round(F.col(name) / F.col("docs"), 1))


def with_total(df: DataFrame, group: str, sums: list[str], label: str = "TOTAL") -> DataFrame:
    """Sums by group and over all, the latter under a label."""
    out = df.rollup(group).agg(*[F.sum(s).alias(s) for s in sums], F.grouping(group).alias("__all"))
    return out.withColumn(group, F.when(F.col("__all") == 1, label).otherwise(F.col(group))).drop("__all")


def purity(df: DataFrame, group: list[str], found: str, target: Column, top: int = 200) -> DataFrame:
    """By group: total, lang_correct, purity_pct and other languages by count as `l=c; ...`, cut to `top` characters."""
    each = df.withColumn("__hit", F.col(found) == target).groupBy(*group, found, "__hit").agg(F.count("*").alias("n"))
    other = F.array_sort(F.collect_list(F.when(~F.col("__hit"), F.struct((-F.col("n")).alias("m"), F.col(found).alias("l")))))
    out = each.groupBy(*group).agg(F.sum("n").alias("total"), F.sum(F.when(F.col("__hit"), F.col("n")).otherwise(0)).alias("lang_correct"), other.alias("__o"))
    joined = F.array_join(F.transform("__o", lambda x: F.concat(x["l"], F.lit("="), (-x["m"]).cast("string"))), "; ")
    return out.withColumn("purity_pct", F.round(100.0 * F.col("lang_correct") / F.col("total"), 2)).withColumn("top_other_langs", F.substring(joined, 1, top)).drop("__o")


def strategy_scores(df: DataFrame, group: list[str], fired: Column, reference: Column, correct: Column, ms: Column) -> DataFrame:
    """Attempts, fired, ref_available, correct, time, and ratios (null where nothing was tried)."""
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    out = df.groupBy(*group).agg(F.count("*").alias("attempts"), n(fired).alias("fired"), n(fired & reference).alias("ref_available"), n(fired & reference & correct).alias("correct"), F.sum(ms).alias("total_ms"))
    return out.withColumns({
        "precision": F.round(share(F.col("correct"), F.col("ref_available")), 4),
        "cost_all": F.round(share(F.col("total_ms"), F.col("attempts")), 4),
        "cost_fired": F.round(share(F.col("total_ms"), F.col("fired")), 4),
    }).withColumn("value", F.round(F.try_divide(F.col("precision"), F.col("cost_all")), 4))


def verdicts(df: DataFrame, group: list[str], value: str, verdict: str) -> DataFrame:
    """Counts of verdicts on filled values, and their ratios."""
    v = F.lower(F.trim(F.coalesce(F.col(verdict), F.lit(""))))
    filled = F.trim(F.coalesce(F.col(value), F.lit(""))) != ""
    n = {k: F.count_if(filled & (v == k)).alias(k) for k in ("correct", "editorial", "wrong", "unknown")}
    labeled = filled & v.isin("correct", "editorial", "wrong")
    out = df.groupBy(*group).agg(F.count_if(filled).alias("filled"), F.count_if(labeled).alias("labeled"), *n.values(), F.count_if(filled & ~v.isin("correct", "editorial", "wrong", "unknown")).alias("unlabeled"))
    return out.withColumns({f"{k}_ratio": F.round(share(F.col(k), F.col("labeled")), 4) for k in ("correct", "editorial", "wrong")} | {"labeled_ratio": F.round(share(F.col("labeled"), F.col("filled")), 4)})


def summary(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """n, mean, median, min, max of a number by group; medians are exact, and no task holds a group's values."""
    simple = df.groupBy(*group).agg(F.count(value).alias("n"), F.round(F.avg(value), 4).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))
    middle = exact_medians(df, group, value).select(F.struct(*group).alias("__g"), "median")
    return simple.join(middle, F.struct(*[simple[g] for g in group]) == F.col("__g")).select(*[simple[g] for g in group], "n", "mean", "median", "min", "max")


def benchmark_summary(df: DataFrame, group: list[str], left_out: Column) -> DataFrame:
    """Over all rows, by the first of group and by all of it: articles, how dates agree with the month in the address, the
    mean of rouge without the rows left_out, and the share with an author. Rows have x_date, url_ym, rouge, x_author."""
    month = F.substring("x_date", 1, 7)
    return df.groupingSets([[], [F.col(group[0])], [F.col(g) for g in group]], *[F.col(g) for g in group]).agg(
        F.count("*").alias("articles"),
        F.count_if(F.col("url_ym").isNotNull() & F.col("x_date").isNull()).alias("date_empty"),
        F.count_if(month == F.col("url_ym")).alias("date_ok"),
        F.count_if(month != F.col("url_ym")).alias("date_wrong"),
        F.round(F.avg(F.when(~left_out, F.col("rouge"))), 4).alias("rouge_mean"),
        F.round(100.0 * F.count("x_author") / F.count("*"), 1).alias("author_pct"),
    )


def coverage(df: DataFrame, group: list[str], names: list[str], columns: dict[str, str] | None = None) -> DataFrame:
    """Over all rows, by the first of group and by all of it: articles and, for each name, <name>_pct, the share of rows with
    that column filled; columns says where a name's column is called otherwise."""
    pct = lambda n: F.round(100.0 * F.count((columns or {}).get(n, n)) / F.count("*"), 1).alias(f"{n}_pct")
    return df.groupingSets([[], [F.col(group[0])], [F.col(g) for g in group]], *[F.col(g) for g in group]).agg(F.count("*").alias("articles"), *map(pct, names))


def found_by(df: DataFrame, group: list[str], a: str, b: str) -> DataFrame:
    """By group: how often both, only a, only b and neither of two columns are filled."""
    x, y = F.col(a).isNotNull(), F.col(b).isNotNull()
    return df.groupBy(*group).agg(F.count_if(x & y).alias("both_found"), F.count_if(x & ~y).alias("only_a"), F.count_if(~x & y).alias("only_b"), F.count_if(~x & ~y).alias("neither"))


def f1(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)


def word_overlap(a: Column | str, b: Column | str) -> Column:
    """struct(precision, recall, f1) of distinct words of a against those of b, 4 places."""
    x, y = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    both = F.size(F.array_intersect(x, y)).cast("double")
    p = F.coalesce(F.try_divide(both, F.size(x).cast("double")), F.lit(0.0))
    r = F.coalesce(F.try_divide(both, F.size(y).cast("double")), F.lit(0.0))
    return F.struct(F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(f1(p, r), 4).alias("f1"))


def rouge_1(a: Column | str, b: Column | str) -> Column:
    """F1 of the multiset overlap of two arrays of words: each word that both have counts as often as in the one with fewer.

    Both arrays are sorted and passed through once together, inside the row.
    """
    x, y = (F.coalesce(F.col(c) if isinstance(c, str) else c, F.array().cast("array<string>")) for c in (a, b))

    def merged(s: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            v, w = F.get(s["x"], at["i"]), F.get(s["y"], at["j"])
            move = lambda i, j, n: F.struct((at["i"] + i).alias("i"), (at["j"] + j).alias("j"), (at["n"] + n).alias("n"))
            return F.when(v == w, move(1, 1, 1)).when(v < w, move(1, 0, 0)).when(v > w, move(0, 1, 0)).otherwise(at)  # null beyond an end

        start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("n"))
        return F.aggregate(F.sequence(F.lit(0), F.size(s["x"]) + F.size(s["y"])), start, step, lambda at: at["n"])

    both = F.array(F.struct(F.array_sort(x).alias("x"), F.array_sort(y).alias("y")))  # bound by transform, so sorted once
    o = F.get(F.transform(both, merged), F.lit(0)).cast("double")
    p, r = (F.coalesce(F.try_divide(o, F.size(t).cast("double")), F.lit(0.0)) for t in (x, y))
    return F.coalesce(F.round(f1(p, r), 4), F.lit(0.0))


def lcs(x: list[str], y: list[str]) -> int:
    """Length of the longest common subsequence, by bit rows."""
    places: dict[str, int] = {}
    for i, w in enumerate(x):
        places[w] = places.get(w, 0) | 1 << i
    row = 0
    for w in y:
        m = places.get(w, 0) | row
        row = m & ~(m - ((row << 1) | 1))
    return row.bit_count()


def _rouge_l(a: pd.Series, b: pd.Series) -> pd.Series:
    def one(x, y):
        x, y = [] if x is None else list(x), [] if y is None else list(y)
        n = lcs(x, y)
        return round(2 * n / (len(x) + len(y)), 4) if n else 0.0

    return pd.Series([one(x, y) for x, y in zip(a, b)])


def rouge_l(a: Column | str, b: Column | str) -> Column:
    """F1 by the longest common subsequence of words; the only measure that needs Python."""
    return F.pandas_udf(_rouge_l, DoubleType())(tokens(a), tokens(b))
