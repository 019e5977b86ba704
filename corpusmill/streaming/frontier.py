"""A crawl's frontier as state: what each host has been asked for, what waits, and when it may be asked again.

Links arrive as rows of files. By host, a stateful operator keeps the set of
addresses seen (forgotten after a time, if one is given), a queue of those that
wait, and a timer: a host gives out at most `burst` addresses, then none until
`pause` has passed. What it gives out is fetched by the batch that got it, and
the links found are written where the stream reads: so each batch is a level of
a breadth-first search, and an address comes with its least depth.

A batch that runs again finds its pages where it left them and fetches nothing;
links that it writes again are known to the state. State is partitioned by
host, so one host's queue lies with one task, by design: politeness is a
host's, and so is its rate.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LINK = "host string, url string, depth int"
#: The store that keeps maps and timers outside the workers' memory.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
Visit = Callable[[DataFrame], DataFrame]


class Frontier(StatefulProcessor):
    """Rows of a host (host, url, depth) in; those that may be fetched now out."""

    def __init__(self, max_depth: int = 3, max_pages: int = 10_000, burst: int = 1_000_000, pause_ms: int = 0, forget_ms: int | None = None):
        self.max_depth, self.max_pages, self.burst, self.pause, self.forget = max_depth, max_pages, burst, pause_ms, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "url string", "depth int", ttlDurationMs=self.forget)
        self.waiting = handle.getMapState("waiting", "n long", "url string, depth int")
        self.ends = handle.getValueState("ends", "head long, tail long, open_at long")

    def _give(self, host: str, head: int, tail: int, open_at: int, now: int) -> Iterator[Row]:
        """What the host gives out, and its timer if more waits."""
        if now >= open_at:
            last = min(tail, head + self.burst)
            for n in range(head, last):
                url, depth = self.waiting.getValue((n,))
                self.waiting.removeKey((n,))
                yield Row(host=host, url=url, depth=depth)
            if last > head:
                open_at = now + self.pause
            head = last
            if head < tail:
                self.handle.registerTimer(open_at)
        self.ends.update((head, tail, open_at))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        head, tail, open_at = self.ends.get() if self.ends.exists() else (0, 0, 0)
        for r in rows:
            if r.depth <= self.max_depth and tail < self.max_pages and not self.seen.containsKey((r.url,)):
                self.seen.updateValue((r.url,), (r.depth,))
                self.waiting.updateValue((tail,), (r.url, r.depth))
                tail += 1
        yield from self._give(key[0], head, tail, open_at, timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._give(key[0], *self.ends.get(), timerValues.getCurrentProcessingTimeInMs())

    def close(self) -> None:
        pass


def _there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


class Crawl:
    """A running crawl. fetch: rows (host, url, depth) to pages, which keep these columns; links: pages to (host, url, depth).

    folder holds links/, pages/ and the stream's state; a crawl started on the same folder goes on where it stopped.
    """

    def __init__(self, spark: SparkSession, folder: str, seeds: DataFrame, fetch: Visit, links: Visit, frontier: Frontier | None = None, every: str = "200 milliseconds", partitions: int | None = None):
        self.folder, self.fetch, self.links, self.last, self.at = folder, fetch, links, -1, time.time()
        own = spark.newSession()
        own.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
        if partitions:  # of the state, which keeps the number that it began with
            own.conf.set("spark.sql.shuffle.partitions", partitions)
        if not _there(own, f"{folder}/links/seeds/_SUCCESS"):
            seeds.select("host", "url", F.lit(0).alias("depth")).write.mode("overwrite").parquet(f"{folder}/links/seeds")
        stream = own.readStream.schema(LINK).option("recursiveFileLookup", "true").parquet(f"{folder}/links")
        given = stream.groupBy("host").transformWithState(frontier or Frontier(), LINK, "Append", "ProcessingTime")
        self.query = given.writeStream.foreachBatch(self._visit).trigger(processingTime=every).option("checkpointLocation", f"{folder}/state").start()

    def _visit(self, batch: DataFrame, n: int) -> None:
        s, pages, found = batch.sparkSession, f"{self.folder}/pages/batch={n}", f"{self.folder}/links/batch={n}"
        if _there(s, f"{pages}/_SUCCESS"):
            batch.write.format("noop").mode("overwrite").save()  # the state moves on; the pages are there
        else:
            self.fetch(batch).write.mode("overwrite").parquet(pages)
        made = s.read.parquet(pages)
        if made.isEmpty():
            return
        self.last, self.at = n, time.time()
        if not _there(s, f"{found}/_SUCCESS"):
            new = self.links(made).select("host", "url", (F.col("depth") + 1).alias("depth"))
            new.where(F.col("url").isNotNull()).distinct().write.mode("overwrite").parquet(found)

    def until_quiet(self, idle: float = 0.0) -> None:
        """Stops the crawl once a batch has found nothing to read and none has given out rows for `idle` seconds; at least twice the pause."""
        try:
            while self.query.isActive:
                p = self.query.lastProgress
                if p is not None and p["batchId"] > self.last + 1 and not p["numInputRows"] and time.time() - self.at >= idle:
                    break
                time.sleep(0.1)
        finally:
            self.query.stop()
        if (e := self.query.exception()) is not None:
            raise e


def visited(spark: SparkSession, folder: str) -> DataFrame:
    """The pages of a crawl, with host, url and depth."""
    return spark.read.parquet(f"{folder}/pages").drop("batch")
