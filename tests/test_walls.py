"""Walls and channels as streams against a local server."""

import json
import threading
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import social
from corpusmill.sources import walls


class Network:
    """Walls and comments; `faults` is how many calls of a method get a flood error before one is answered."""

    def __init__(self):
        self.walls, self.comments, self.threads = {}, {}, {}
        self.faults, self.calls, self.removed = {}, [], {}

    def answer(self, method, p):
        self.calls.append((method, p))
        if self.faults.get(method, 0) > 0 and int(p.get("count", 0)) != 2:
            self.faults[method] -= 1
            return {"error": {"error_code": 9, "error_msg": "Flood control"}}
        if method == "messages":
            below = int(p["offset_id"]) or 10**9
            return {"response": {"items": [x for x in self.walls[p["channel"]] if x["id"] < below][: int(p["limit"])]}}
        if method == "wall.getComments":
            rows = self.threads[int(p["comment_id"])] if "comment_id" in p else self.comments[int(p["post_id"])]
        elif p["domain"] not in self.walls:
            return {"error": {"error_code": 18, "error_msg": "page deleted"}}
        else:
            rows = self.walls[p["domain"]]
        a = int(p["offset"])
        got = {"response": {"count": len(rows), "items": rows[a : a + int(p["count"])]}}
        for i in self.removed.pop((method, a), []):  # removed after this page was given
            rows[:] = [x for x in rows if x["id"] != i]
        return got


def post(i, **more):
    return {"id": i, "owner_id": -1, "date": 1700000000 + i, "text": f"post {i}"} | more


@pytest.fixture
def network():
    net = Network()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            url = urllib.parse.urlsplit(self.path)
            body = json.dumps(net.answer(url.path.strip("/"), dict(urllib.parse.parse_qsl(url.query)))).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    net.address = f"http://127.0.0.1:{s.server_port}"
    yield net
    s.shutdown()


FAST = {"rate": 1000, "pause": 0.01, "tries": 3}


def run(spark, network, names, folder, **options):
    stream = walls.read_walls(spark, network.address, names, **FAST | options)
    q = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/rows")
    try:
        q.awaitTermination()
    finally:
        q.stop()
    return sorted((r.domain, r.post_id) for r in spark.read.parquet(f"{folder}/rows").collect())


def test_a_wall_restarts_without_repeats_or_losses(spark, network, tmp_path):
    network.walls = {"a": [post(3, is_pinned=1)] + [post(i) for i in range(250, 3, -1)] + [post(2), post(1)], "b": [post(7)], "empty": []}
    network.faults = {"wall.get": 2}
    names = ["a", "b", "empty", "gone"]
    want = [("a", i) for i in range(1, 251)] + [("b", 7)]
    assert run(spark, network, names, tmp_path) == want
    assert run(spark, network, names, tmp_path) == want
    network.walls["a"].insert(1, post(251))
    network.walls["b"] = [post(9), post(8)] + network.walls["b"]
    network.faults = {"wall.get": 50}  # outlasts the tries: the batch fails after it is planned
    with pytest.raises(Exception, match="Flood"):
        run(spark, network, names, tmp_path)
    network.faults, network.calls = {}, []
    network.walls["a"].insert(1, post(252))  # after the failed batch was planned
    planned = set(want) | {("a", 251), ("b", 8), ("b", 9)}
    assert planned <= set(run(spark, network, names, tmp_path)) <= planned | {("a", 252)}  # a run may end with the planned batch
    assert run(spark, network, names, tmp_path) == sorted(planned | {("a", 252)})
    assert max(int(p["offset"]) for m, p in network.calls) < 250  # older pages aren't read again


def test_a_channel_is_paged_by_id(spark, network, tmp_path):
    network.walls = {"c": [post(i) for i in range(500, 0, -2)]}
    assert run(spark, network, ["c"], tmp_path, kind="channel") == [("c", i) for i in range(2, 501, 2)]
    network.walls["c"].insert(0, post(501))
    assert len(run(spark, network, ["c"], tmp_path, kind="channel")) == 251
    body = spark.read.parquet(f"{tmp_path}/rows").select(F.from_json("body", "id long, date long, text string, views long, forwards long").alias("m")).select("m.*")
    assert social.telegram_posts(body, "c").count() == 251


def test_pages_meet_although_the_list_changes(network):
    network.walls = {"a": [post(i) for i in range(400, 0, -1)]}
    network.removed = {("wall.get", 0): range(400, 340, -1), ("wall.get", 99): [241]}
    call = walls.Calls(FAST | {"api": network.address}, 0.0)
    got = [x["id"] for x in walls.new_posts(call, "a", 0, 400)]
    assert len(got) == len(set(got)) and set(got) >= {x["id"] for x in network.walls["a"]}
    assert [x["id"] for x in walls.new_posts(call, "a", 5, 7)] == [7, 6]
    with pytest.raises(walls.Closed):
        list(walls.new_posts(call, "none", 0, 1))


def test_calls_keep_the_rate_and_pause_longer_each_time(network):
    network.walls, network.faults = {"a": [post(1)]}, {"wall.get": 2}
    slept = []
    call = walls.Calls({"api": network.address, "pause": 3}, 0.0, sleep=slept.append)
    assert call("wall.get", domain="a", count=1, offset=0)["count"] == 1
    assert [s for s in slept if s] == [3.0, 6.0]
    reader = walls.WallReader({"api": "x", "names": "a,b,c,d", "rate": "2", "partitions": "3"})
    parts = reader.partitions({"a": 5}, {"a": 5, "b": 1, "c": 1, "d": 1})
    assert [p.walls[0][0] for p in parts] == ["b", "c", "d"] and {p.gap for p in parts} == {1.5} and [p.wait for p in parts] == [0, 0.5, 1]


def test_comments_with_their_threads(spark, network):
    reply = lambda i: {"id": i, "date": 1, "text": f"reply {i}", "parents_stack": [1]}
    long = [reply(i) for i in range(1000, 1230)]
    network.comments = {5: [{"id": 1, "date": 1, "text": "root", "thread": {"count": 230, "items": long[:10]}}, {"id": 2, "date": 1, "text": "other", "thread": {"count": 1, "items": [reply(3)]}}] + [{"id": i, "date": 1, "text": "x"} for i in range(10, 200)], 6: []}
    network.threads = {1: long}
    posts = spark.createDataFrame([(-1, 5, 192), (-1, 6, 1), (-1, 7, 0), (-1, 8, None), (None, 9, 3)], "owner_id long, post_id long, comments long")
    rows = walls.read_comments(posts, network.address, tasks=2, **FAST)
    got = sorted((r.post_id, r.parent_comment_id, r.comment_id) for r in rows.collect())
    want = [(5, 0, 1), (5, 0, 2)] + [(5, 0, i) for i in range(10, 200)] + [(5, 1, i) for i in range(1000, 1230)] + [(5, 2, 3)]
    assert got == sorted(want)
    assert not any(m == "wall.getComments" and p["post_id"] in ("7", "8", "9") for m, p in network.calls)
    shaped = social.vk_comments(rows, "body", "post_id")
    assert shaped.where("parent_comment_id = 1").count() == 231
