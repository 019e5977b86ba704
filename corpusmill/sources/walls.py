"""Walls and channels of social networks as streams, and the comments of a table of posts.

Ids on a wall grow, and its API gives pages from the newest on. A batch holds, of each wall, the ids above the last
batch's and up to the newest when it was planned; so a batch that runs again asks for the same ids, and a stream that
starts again from its checkpoint repeats nothing and loses nothing. The calls of a batch keep to one rate: each of its
n tasks takes an n-th of it.
"""

from __future__ import annotations

import json
import time
import urllib.parse
from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .web import fetch

PAGE = 100
#: Inline replies that the API gives with a comment; longer threads are asked for on their own.
INLINE = 10
#: Fixed values of the API: its version, errors that ask for a pause, and errors of what is private or gone.
VERSION, FLOOD, CLOSED = "5.199", {6, 9, 10}, {15, 18, 19, 30, 100, 113, 125, 212}
ROW = ["domain", "post_id", "body", "error"]


class Closed(RuntimeError):
    """The API says that a wall is private, deleted or unknown."""


class Calls:
    """Calls of one task: `gap` seconds apart, repeated after a pause or a fault; after the last try it raises."""

    def __init__(self, options: dict, gap: float | None = None, wait: float = 0.0, sleep: Callable[[float], None] = time.sleep):
        self.api, self.token, self.tries = options["api"].rstrip("/"), options.get("token", ""), int(options.get("tries", 5))
        self.pause, self.gap, self.sleep = float(options.get("pause", 3.0)), 1 / float(options.get("rate", 2.5)) if gap is None else gap, sleep
        self.next = time.monotonic() + wait

    def __call__(self, method: str, **params) -> dict:
        url = f"{self.api}/{method}?" + urllib.parse.urlencode(params | {"access_token": self.token, "v": VERSION})
        for attempt in range(self.tries):
            self.sleep(max(0.0, self.next - time.monotonic()))
            self.next = time.monotonic() + self.gap
            try:
                answer = json.loads(fetch(url, 1))
            except (OSError, ValueError) as e:
                problem = f"{type(e).__name__}: {e}"
                self.sleep(min(1.0, self.pause))
                continue
            if "error" not in answer:
                return answer["response"]
            code, problem = answer["error"].get("error_code", 0), answer["error"].get("error_msg", "")
            if code in CLOSED:
                raise Closed(f"{code}: {problem}")
            if code in FLOOD or "flood" in problem.lower() or "too many requests" in problem.lower():
                self.sleep(self.pause * (attempt + 1))
            else:
                self.sleep(min(1.0, self.pause))
        raise RuntimeError(f"{method} failed {self.tries} times: {problem}")


def pages(ask: Callable[[int], dict], enough: Callable[[list[dict]], bool] = lambda items: False) -> Iterator[dict]:
    """Each item of a list that is paged by offset, once, until a page is `enough` or the list ends.

    A page starts with the last item of the page before. Where what was added meanwhile shifts the list, items that
    were seen come again and are left out; where items were removed, the pages no longer meet, and an earlier offset
    is asked for until they do.
    """
    seen: set[int] = set()
    offset, back = 0, 0
    while True:
        answer = ask(offset)
        items = [x for x in answer.get("items", []) if "id" in x and "date" in x]
        if offset and seen.isdisjoint(x["id"] for x in items):
            back += 1
            if back > 1000:
                raise RuntimeError("the pages of a list don't meet")
            offset = max(0, offset - PAGE // 2)
            continue
        for x in items:
            if x["id"] not in seen:
                seen.add(x["id"])
                yield x
        got = len(answer.get("items", []))
        if not got or offset + got >= answer.get("count", 0) or enough(items):
            return
        offset += max(1, got - 1)


def new_posts(call: Calls, wall: str, after: int, upto: int) -> Iterator[dict]:
    """A wall's posts with after < id <= upto; it reads on until a whole page, a pinned post aside, is older."""
    ask = lambda offset: call("wall.get", domain=wall, count=PAGE, offset=offset)
    for x in pages(ask, lambda items: all(x["id"] <= after for x in items if not x.get("is_pinned"))):
        if after < x["id"] <= upto:
            yield x


def new_messages(call: Calls, channel: str, after: int, upto: int) -> Iterator[dict]:
    """A channel's messages with after < id <= upto, from a gateway that gives those below an id, newest first."""
    below = upto + 1
    while items := call("messages", channel=channel, limit=PAGE, offset_id=below)["items"]:
        yield from (x for x in items if after < x["id"] < below)
        least = min(x["id"] for x in items)
        if least <= after + 1 or least >= below:
            return
        below = least


def newest(call: Calls, kind: str, name: str) -> int:
    """The greatest id on a wall or channel; 0 if it is empty or closed. A pinned post comes first, so two are asked for."""
    try:
        found = call("wall.get", domain=name, count=2, offset=0) if kind == "wall" else call("messages", channel=name, limit=1, offset_id=0)
    except Closed:
        return 0
    return max((x["id"] for x in found["items"] if "id" in x), default=0)


class Range(InputPartition):
    """(name, after, upto) of walls that one task reads, the seconds between its calls and before the first."""

    def __init__(self, walls: list[tuple[str, int, int]], gap: float, wait: float):
        super().__init__(None)
        self.walls, self.gap, self.wait = walls, gap, wait


class WallReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options, self.names, self.kind = options, [n.strip() for n in options["names"].split(",") if n.strip()], options.get("kind", "wall")
        self.parts, self.rate = int(options.get("partitions", 3)), float(options.get("rate", 2.5))
        if self.kind not in ("wall", "channel"):
            raise ValueError("kind is wall or channel")

    def initialOffset(self) -> dict:
        return {n: 0 for n in self.names}

    def latestOffset(self) -> dict:
        call = Calls(self.options)
        return {n: newest(call, self.kind, n) for n in self.names}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        todo = [(n, start.get(n, 0), upto) for n, upto in sorted(end.items()) if upto > start.get(n, 0)]
        dealt = [todo[i :: self.parts] for i in range(min(self.parts, len(todo)))]
        return [Range(d, len(dealt) / self.rate, i / self.rate) for i, d in enumerate(dealt)]

    def read(self, partition: Range) -> Iterator[tuple]:
        call, new = Calls(self.options, partition.gap, partition.wait), new_posts if self.kind == "wall" else new_messages
        for name, after, upto in partition.walls:
            try:
                for x in new(call, name, after, upto):
                    yield name, x["id"], json.dumps(x, ensure_ascii=False), None
            except Closed as e:
                yield name, None, None, str(e)[:200]


class SocialWalls(DataSource):
    """domain, post_id, body, error of what is new on the walls or channels in the option `names`, joined by commas.

    Options: api, token, kind (wall or channel), rate (calls a second, 2.5), partitions (3), tries (5), pause (3
    seconds, once more with each try). Where a network's pause or fault outlasts the tries, the batch fails and
    runs again. A wall that closes while it is read gives one row with the error; one that is closed when a batch is
    planned is passed over, and read from its first post if it opens again: keep rows by key (landed.resume).
    """

    @classmethod
    def name(cls) -> str:
        return "social_walls"

    def schema(self) -> str:
        return "domain string, post_id long, body string, error string"

    def streamReader(self, schema) -> WallReader:
        return WallReader({k.lower(): v for k, v in self.options.items()})


def read_walls(spark: SparkSession, api: str, names: list[str], **options) -> DataFrame:
    """A stream of (domain, post_id, body, error); operators.social gives bodies their shape."""
    spark.dataSource.register(SocialWalls)
    reader = spark.readStream.format("social_walls").option("api", api).option("names", ",".join(names))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def comments_of(call: Calls, owner: int, post: int) -> Iterator[tuple[int, dict]]:
    """(id of the thread's root or 0, comment) of all comments of a post; a thread longer than what is inline is read in full."""
    ask = lambda offset, **more: call("wall.getComments", owner_id=owner, post_id=post, count=PAGE, offset=offset, need_likes=1, extended=0, **more)
    for root in pages(lambda offset: ask(offset, thread_items_count=INLINE)):
        thread = root.pop("thread", None) or {}
        yield 0, root
        inline = thread.get("items") or []
        replies = pages(lambda offset, r=root["id"]: ask(offset, comment_id=r)) if len(inline) < thread.get("count", 0) else inline
        yield from ((root["id"], x) for x in replies)


def read_comments(posts: DataFrame, api: str, tasks: int = 3, **options) -> DataFrame:
    """owner_id, post_id, parent_comment_id, comment_id, body, error: the comments of posts (owner_id, post_id, comments).

    Posts without comments (a count of null or 0) aren't asked for. Posts are dealt to `tasks` tasks, which share the
    rate; a closed post gives one row with the error.
    """
    settings = {k: str(v) for k, v in options.items()} | {"api": api}
    rate = float(settings.get("rate", 2.5))
    columns = ["owner_id", "post_id", "parent_comment_id", "comment_id", "body", "error"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = Calls(settings, tasks / rate)

        def rows() -> Iterator[tuple]:
            for f in frames:
                for owner, post in zip(f["owner_id"].tolist(), f["post_id"].tolist()):
                    try:
                        for root, x in comments_of(call, owner, post):
                            yield owner, post, root, x["id"], json.dumps(x, ensure_ascii=False), None
                    except Closed as e:
                        yield owner, post, None, None, None, str(e)[:200]

        made = rows()
        while some := list(islice(made, 1000)):
            yield pd.DataFrame(some, columns=columns).astype({"parent_comment_id": "Int64", "comment_id": "Int64"})

    asked = posts.where((F.col("comments") > 0) & F.col("owner_id").isNotNull() & F.col("post_id").isNotNull())
    return asked.select("owner_id", "post_id").repartition(tasks, "owner_id", "post_id").mapInPandas(run, "owner_id long, post_id long, parent_comment_id long, comment_id long, body string, error string")
