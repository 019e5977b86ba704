"""Pages and JSON APIs over HTTP as Spark data sources, with retries, politeness and robots rules.

spark.read.format("web_pages") fetches the addresses in a table of lines; those
of one host stay in one partition so that the delay between fetches holds for
the host. A page that can't be fetched has a row with its error, so a job is
whole and a later one can fetch what is missing (anti join with what is there).
"""

from __future__ import annotations

import json
import random
import time
import urllib.error
import urllib.parse
import urllib.request
import urllib.robotparser
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.urls import domain

HEADERS = {"User-Agent": "Mozilla/5.0 (compatible; corpusmill)", "Accept": "text/html,application/json;q=0.9,*/*;q=0.5", "Accept-Language": "tt,tg,ru;q=0.8,en;q=0.5"}


def fetch(url: str, tries: int = 3, base: float = 1.6, timeout: float = 25.0, lang_cookie: str | None = None, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """The body of a page; after a failure it waits base^attempt and a little more, after the last it raises."""
    if tries < 1:
        raise ValueError("tries must be 1 or more")
    headers = HEADERS | ({"Cookie": f"lang={lang_cookie}"} if lang_cookie else {})
    for attempt in range(tries):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
                return r.read()
        except (OSError, ValueError):
            if attempt + 1 == tries:
                raise
            sleep(base**attempt + random.uniform(0.15, 0.9))
    raise AssertionError("unreachable")


def allowed(url: str, agent: str = "*") -> bool:
    """What robots.txt says; where it can't be read, yes."""
    parts = urllib.parse.urlsplit(url)
    rules = urllib.robotparser.RobotFileParser(f"{parts.scheme}://{parts.netloc}/robots.txt")
    try:
        rules.read()
    except (OSError, ValueError):
        return True
    return rules.can_fetch(agent, url)


def amp_address(url: str, mode: str) -> str | None:
    """The address tried when a page can't be fetched: none, prefix or suffix."""
    p = urllib.parse.urlsplit(url)
    path = {"prefix": "/amp" + p.path if p.path.startswith("/") else "/amp/" + p.path, "suffix": p.path.rstrip("/") + "/amp"}.get(mode)
    return f"{p.scheme}://{p.netloc}{path}" if path else None


class HostPartition(InputPartition):
    def __init__(self, urls: Iterable[str]):
        super().__init__(None)
        self.urls = urls


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = [u for u in options["urls"].split("\n") if u.strip()]
        self.parts, self.tries = int(options.get("partitions", 8)), int(options.get("tries", 3))
        self.delay, self.robots, self.amp = float(options.get("delay", 1.2)), options.get("robots", "false") == "true", options.get("amp", "none")

    def partitions(self) -> list[HostPartition]:
        held: dict[int, list[str]] = {}
        for u in self.urls:
            held.setdefault(zlib.crc32(urllib.parse.urlsplit(u).netloc.lower().encode()) % self.parts, []).append(u)
        return [HostPartition(v) for v in held.values()] or [HostPartition([])]

    def read(self, partition: HostPartition) -> Iterator[tuple]:
        for i, url in enumerate(partition.urls):
            if i:
                time.sleep(self.delay)
            if self.robots and not allowed(url):
                yield url, None, "disallowed by robots.txt"
                continue
            try:
                try:
                    body = fetch(url, self.tries)
                except (OSError, ValueError):
                    if not (other := amp_address(url, self.amp)):
                        raise
                    body = fetch(other, self.tries)
                yield url, body.decode("utf-8", "replace"), None
            except (OSError, ValueError) as e:
                yield url, None, f"{type(e).__name__}: {e}"[:200]


class WebPages(DataSource):
    """url, html, error of the addresses in the option `urls`, one a line."""

    @classmethod
    def name(cls) -> str:
        return "web_pages"

    def schema(self) -> str:
        return "url string, html string, error string"

    def reader(self, schema) -> PageReader:
        return PageReader({k.lower(): v for k, v in self.options.items()})


def read_pages(spark: SparkSession, urls: list[str], **options) -> DataFrame:
    spark.dataSource.register(WebPages)
    reader = spark.read.format("web_pages").option("urls", "\n".join(urls))
    for k, v in options.items():
        reader = reader.option(k, str(v).lower() if isinstance(v, bool) else v)
    return reader.load()


def fetch_table(addresses: DataFrame, column: str = "url", tasks: int = 64, **options) -> DataFrame:
    """url, html, error of the addresses in a table, of any number. Those of a host go to one task, so that the delay holds for it."""
    reader = PageReader({k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()} | {"urls": ""})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = reader.read(HostPartition(u for f in frames for u in f[column]))
        while some := list(islice(rows, 32)):
            yield pd.DataFrame(some, columns=["url", "html", "error"])

    return addresses.select(column).where(F.col(column).isNotNull()).repartition(tasks, domain(column)).mapInPandas(run, "url string, html string, error string")


def last_page(has_items: Callable[[int], bool], fixed: int | None = None, limit: int = 1 << 20) -> int:
    """The last page with items: fixed, or by doubling and then halving the gap; 0 if the first is empty."""
    if fixed is not None:
        return fixed
    if not has_items(1):
        return 0
    lo = 1
    while lo < limit and has_items(lo * 2):
        lo *= 2
    hi = lo * 2
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if has_items(mid) else (lo, mid)
    return lo


def at_path(data, path: str):
    """A value by a dotted path; numbers are places in lists; null where it leads nowhere."""
    for key in filter(None, path.split(".")):
        data = data.get(key) if isinstance(data, dict) else data[int(key)] if isinstance(data, list) and key.isdigit() and int(key) < len(data) else None
        if data is None:
            return None
    return data


def read_api(spark: SparkSession, template: str, items_path: str, fixed_last_page: int | None = None, **options) -> DataFrame:
    """(url, html, error) of all pages of a JSON API; html holds the body. template has {page}."""

    def has_items(page: int) -> bool:
        return bool(at_path(json.loads(fetch(template.format(page=page))), items_path))

    n = last_page(has_items, fixed_last_page)
    return read_pages(spark, [template.format(page=i) for i in range(1, n + 1)], **options)
