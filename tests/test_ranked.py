"""Pattern joins, threads, medians and greatest counts against plain loops."""

import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import patterns, ranks, threads
from corpusmill.sources import files


def test_patterns_of_all_lengths(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcé.") for _ in range(n))
    texts = [word(rng.randrange(0, 14)) for _ in range(400)] + [None, "", "common.example"] * 3 + [f"{word(3)}.example" for _ in range(300)]
    rules = [word(rng.randrange(0, 7)) for _ in range(150)] + [None, "", "example", "x" * 40, "e"]
    t, p = spark.createDataFrame([(x,) for x in texts], "t string"), spark.createDataFrame([(x,) for x in rules], "p string")
    found = patterns.contains_join(t, "t", p, "p")
    assert sorted(map(tuple, found.collect())) == sorted({(a, b) for a in texts if a is not None for b in rules if b and b in a})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = patterns.contains_join(t, "t", p, "p")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert patterns.contains_join(t, "t", p.limit(0), "p").count() == 0 == patterns.contains_join(t.limit(0), "t", p, "p").count()


def test_ten_thousand_rules(spark):
    hosts = [f"www.site{i}.example" for i in range(3000)]
    rules = [(f"site{i}.", i) for i in range(5000)] + [(f"e{i}.ex", -i) for i in range(1, 5001)]
    got = patterns.longest_match(spark.createDataFrame([(h,) for h in hosts], "h string"), "h", spark.createDataFrame(rules, "pattern string, site long"))
    values = {r.text: r.value for r in got.collect()}
    for i in (0, 1, 10, 999, 2999):
        assert values[hosts[i]] == max((len(p), s) for p, s in rules if p in hosts[i])[1]
    assert len(values) == 3000


def places(rows):
    parent = {}
    for i, p in rows:
        if i is not None:
            parent[i] = p if i not in parent or (p is not None and (parent[i] is None or p < parent[i])) else parent[i]
    out = []
    for i in parent:
        path, at = [i], i
        while parent[at] is not None and parent[at] in parent and len(path) <= len(parent):
            at = parent[at]
            path.append(at)
        out.append((i, None, None, None) if len(path) > len(parent) else (i, at, len(path) - 1, path[::-1]))
    return sorted(out)


def test_threads_with_chains_circles_and_orphans(spark):
    files.ensure_checkpoint_dir(spark)
    rng = random.Random(1)
    rows = [(i, rng.choice([None, rng.randrange(i), rng.randrange(i)]) if i else None) for i in range(200)]
    rows += [(1000 + i, 1000 + i - 1 if i else None) for i in range(60)] + [(2000, 2001), (2001, 2002), (2002, 2000), (2003, 2000), (3000, 9999), (None, 5), (3001, 3001), (150, None)]
    rows += [(4000 + i, 7) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, parent long").withColumn("root", F.lit(1))
    got = threads.thread_places(df)
    want = places(rows)
    assert sorted((r.id, r.root, r.depth, r.path) for r in got.collect()) == want
    counts = {r.id: (r.replies, r.below) for r in threads.reply_counts(df, got).collect()}
    assert counts[7][0] == sum(p == 7 for _, p in rows) and counts[1000] == (1, 59) and counts[2000] == (2, None)
    assert threads.thread_places(df.limit(0)).count() == 0


def test_medians_of_any_numbers(spark):
    files.ensure_checkpoint_dir(spark)
    rng = random.Random(2)
    rows = [("even", float(i)) for i in range(1000)] + [("one", 5.5)] + [("nulls", None)] * 3 + [(None, x) for x in (3.0, None, 1.0)] + [("wide", rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300)) for _ in range(999)]
    rows += [("same", 2.5)] * 400 + [("skew", 1.0)] * 50 + [("skew", rng.gauss(0, 1e-9)) for _ in range(50)] + [("odd", float("nan")), ("odd", float("inf")), ("odd", 4.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    want = {}
    for g in {g for g, _ in rows}:
        own = [x for k, x in rows if k == g and x is not None and abs(x) < float("inf")]
        want[g] = statistics.median(own) if own else None
    for parts in (64, 8):
        assert {r.g: r.median for r in ranks.exact_medians(df, ["g"], "x", parts).collect()} == want
    whole = spark.createDataFrame([(-(1 << 63) // 1,), ((1 << 63) - 1,), (7,)], "x long")
    assert [r.median for r in ranks.exact_medians(whole.withColumn("g", F.lit(1)), ["g"], "x").collect()] == [7.0]


@pytest.mark.parametrize("n", [5, 400])
def test_top_n_is_exact(spark, n):
    files.ensure_checkpoint_dir(spark)
    rng = random.Random(3)
    keys = [int(rng.paretovariate(0.6)) % 300 for _ in range(3000)]
    df = spark.createDataFrame([(None if k == 299 else f"k{k}", i) for i, k in enumerate(keys)], "k string, at long")
    count, first = Counter(f"k{k}" for k in keys if k != 299), {}
    for i, k in enumerate(keys):
        first.setdefault(f"k{k}", i)
    by_key = sorted(count.items(), key=lambda x: (-x[1], x[0]))[:n]
    by_first = sorted(count.items(), key=lambda x: (-x[1], first[x[0]]))[:n]
    assert [tuple(r) for r in ranks.top_n(df.select("k"), "k", n).collect()] == by_key
    for buckets in (1 << 16, 7):
        assert [tuple(r) for r in ranks.top_n(df, "k", n, buckets, F.min("at")).collect()] == by_first
