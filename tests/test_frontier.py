"""The crawl as a stream against a plain breadth-first search."""

from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from corpusmill.streaming import frontier as T

LINKS = {"a/0": ["a/1", "b/0", "a/0"], "a/1": ["a/2", "a/3", "b/1"], "b/0": ["a/3", "b/2"], "a/2": ["a/4"], "a/3": ["a/4", None], "b/2": ["b/3"], "b/3": ["b/4"], "a/4": ["a/5"]}


def plain(depth):
    seen, todo = {"a/0": 0}, deque(["a/0"])
    while todo:
        u = todo.popleft()
        for v in LINKS.get(u, []):
            if v is not None and v not in seen and seen[u] < depth:
                seen[v] = seen[u] + 1
                todo.append(v)
    return seen


def host(c):
    return F.get(F.split(c, "/"), F.lit(0))


@pytest.fixture
def crawl(spark, tmp_path):
    table = spark.createDataFrame([(u, v) for u, vs in LINKS.items() for v in vs], "src string, dst string")
    table.write.parquet(str(tmp_path / "table"))
    fetched = []

    def fetch(batch):
        fetched.extend(r.url for r in batch.collect())
        return batch

    def links(pages):
        t = pages.sparkSession.read.parquet(str(tmp_path / "table"))
        return pages.join(t, F.col("url") == F.col("src")).select(host(F.col("dst")).alias("host"), F.col("dst").alias("url"), "depth")

    def start(frontier=None):
        return T.Crawl(spark, f"file:{tmp_path}/crawl", spark.createDataFrame([("a", "a/0"), ("a", "a/0")], "host string, url string"), fetch, links, frontier)

    return start, fetched, f"file:{tmp_path}/crawl", tmp_path


def test_equals_a_search_and_fetches_once(spark, crawl):
    start, fetched, folder, _ = crawl
    start(T.Frontier(max_depth=3)).until_quiet()
    want = plain(3)
    assert {r.url: r.depth for r in T.visited(spark, folder).collect()} == want
    assert Counter(fetched) == Counter(list(want))


def test_a_batch_that_runs_again_fetches_nothing(spark, crawl):
    import shutil

    start, fetched, folder, tmp_path = crawl
    start(T.Frontier(max_depth=1)).until_quiet()
    n = len(fetched)
    commits = sorted((tmp_path / "crawl/state/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()  # as if the last batch had died before it was committed
    for crc in (tmp_path / "crawl/state/commits").glob(".*.crc"):
        crc.unlink()
    start(T.Frontier(max_depth=1)).until_quiet()
    assert len(fetched) == n == len(plain(1))
    shutil.rmtree(tmp_path / "crawl/state")  # even with all state gone, pages that are there aren't fetched again under their batch
    assert {r.url: r.depth for r in T.visited(spark, folder).collect()} == plain(1)


def test_hosts_wait_between_bursts_and_keep_within_their_pages(spark, crawl):
    start, fetched, folder, _ = crawl
    start(T.Frontier(max_depth=9, burst=1, pause_ms=300, max_pages=4)).until_quiet(3.0)
    got = Counter(u.split("/")[0] for u in fetched)
    assert got == {"a": 4, "b": 4} and max(Counter(fetched).values()) == 1
    batches = spark.read.parquet(f"{folder}/pages").groupBy("batch", "host").count().collect()
    assert all(r["count"] == 1 for r in batches)
