import json

import pytest

from evidora.errors import NetworkError, RateLimitError, TimeoutError_, UpstreamError
from evidora.operators import insight
from evidora.plans import ingest
from evidora.sources.client import Bucket, Client, apply_schedules, headroom
from tests_fixtures import comment, post, review


def search(spark, hits, items, bounds=(100, 200, True), size=2, pages=2):
    h = spark.createDataFrame(hits, "query_idx int, hit_id string, at long")
    i = spark.createDataFrame([(k, s, b if isinstance(b, str) else json.dumps(b)) for k, s, b in items], "hit_id string, status int, body string")
    documents, report = ingest.search(h, i, bounds, size, pages)
    return sorted(r.source_id for r in documents.collect()), report.first()


def item(n, at):
    return (str(n), 200, {"id": n, "type": "story", "time": at})


def test_search_uncapped_and_capped(spark):
    hits = [(0, "1", 110), (0, "2", 120), (1, "2", 120), (0, "9", 50)]
    got, report = search(spark, hits, [item(1, 110), item(2, 120)])
    assert got == ["1", "2"] and (report.boundary, report.cursor, report.truncated) == (200, 200, False)
    hits = [(0, str(n), at) for n, at in enumerate([190, 180, 170, 160, 150, 150, 140, 130])]  # four pages; the oldest two: 150 150 140 130
    got, report = search(spark, hits, [item(n, 1) for n in range(8)])
    assert got == ["4", "5", "6", "7"] and report.cursor == 140 and not report.truncated  # never the newest second of a capped read
    got, report = search(spark, [(0, str(n), 150) for n in range(8)], [item(n, 1) for n in range(8)])
    assert report.boundary == 100 and report.cursor is None and report.truncated  # all in one second: stalled
    got, report = search(spark, [(0, "1", 50)], [])
    assert got == [] and report.cursor == 200


def test_search_failures(spark):
    hits = [(0, "1", 110), (0, "2", 120), (0, "3", 130)]
    _, report = search(spark, hits, [item(1, 1), ("2", 503, "{}"), item(3, 1)], size=10)
    assert report.cursor == 119 and not report.truncated
    _, report = search(spark, hits, [("1", 503, "{}"), item(2, 1)], bounds=(110, 200, True), size=10)
    assert report.boundary == 109 and report.cursor is None and report.truncated
    _, report = search(spark, hits, [("1", 200, {"id": "x"}), item(2, 1), ("3", 200, "null")], size=10)
    assert report.cursor == 200 and report.truncated  # one of two could not be read; the filtered one doesn't count


def test_feed(spark):
    def entry(n, day):
        return review(id={"label": n}, updated={"label": f"2025-01-{day:02d}T00:00:00-00:00"})

    body = lambda *e: json.dumps({"feed": {"entry": list(e)}})
    pages = [(0, "1", "us", 1, 200, body(entry("a", 9), entry("b", 8), {"bad": 1})), (0, "1", "us", 2, 200, body(entry("c", 5), entry("d", 7))),
             (1, "2", "us", 1, 200, body(entry("e", 3))), (2, "3", "us", 1, 503, ""), (3, "4", "us", 1, 200, body(entry("f", 3)))]
    marks = [("1:us", "2025-01-05T00:00:00.000Z"), ("3:us", "m"), ("2:us", "2025-01-04T00:00:00.000Z")]
    documents, report = ingest.feed(spark.createDataFrame(pages, "ordinal int, app_id string, territory string, page int, status int, body string"), spark.createDataFrame(marks, "pair string, mark string"))
    assert sorted(r.source_id for r in documents.collect()) == ["a", "b"]  # d comes after the row that stopped the walk
    got = {r.pair: (r.mark, r.failed) for r in report.collect()}
    assert got == {"1:us": ("2025-01-09T00:00:00.000Z", False), "2:us": ("2025-01-03T00:00:00.000Z", False), "3:us": ("m", True)}  # a mark may go back; pair 4 was not attempted


def test_listing(spark):
    listing = lambda *d: json.dumps({"kind": "Listing", "data": {"after": "n", "children": [{"kind": "t3", "data": x} for x in d]}})
    pages = [(1, listing(post(), post(id="b", name="t3_b", num_comments=2))), (2, listing(post(id="c", name="t3_c", title=...), post(id="d", name="t3_d", num_comments=1))), (3, listing(post(id="e", name="t3_e"))), (4, "{}")]
    thread = json.dumps([{}, {"data": {"children": [comment("x"), comment("y", body=...), comment("z", body=...)]}}])
    threads = [("a1", 200, thread), ("e", 500, "")]
    documents, report = ingest.listing(spark.createDataFrame(pages, "page int, body string"), spark.createDataFrame(threads, "thread string, status int, body string"))
    assert sorted(r.source_id for r in documents.collect()) == ["t1_x", "t3_a1", "t3_b", "t3_d", "t3_e"]
    got = {r.page: (r.posts, r.unmapped, r.comments, r.unmapped_comments, r.truncated, r.failed) for r in report.collect()}
    assert got == {1: (2, 0, 1, 2, True, False), 2: (1, 1, 0, 0, True, False), 3: (1, 0, 0, 0, False, True), 4: (0, 0, 0, 0, False, True)}


def test_client():
    slept, now = [], [0.0]

    def client(answers, **more):
        it = iter(answers)

        def send(url, headers):
            a = next(it)
            if isinstance(a, BaseException):
                raise a
            return a

        slept.clear()
        return Client(send, lambda: now[0], slept.append, lambda: 0.5, **more)

    assert client([(503, {}, ""), (200, {}, "x")]).request("https://h/")[2] == "x" and slept == [125.0]
    assert client([(429, {"retry-after": "7"}, ""), (404, {}, "no")]).request("https://h/")[0] == 404 and slept == [7000]
    for answers, error in (([(429, {}, "")] * 5, RateLimitError), ([(500, {}, "")] * 5, UpstreamError), ([TimeoutError()] * 5, TimeoutError_), ([OSError()] * 5, NetworkError)):
        with pytest.raises(error):
            client(answers).request("https://h/")
        assert slept == [125.0, 250.0, 500.0, 1000.0]
    limited = client([(200, {}, "")] * 3, limits={"h": (2, 1000)})
    for _ in range(3):
        limited.request("https://h/")
    assert slept == [500.0]
    b = Bucket(2, 1000)
    assert [b.wait_ms(t) for t in (0, 0, 0, 0, 2000)] == [0, 0, 500, 1000, 0]
    assert headroom({"x-ratelimit-used": "3", "x-ratelimit-reset": "x"}) == {"used": 3.0} and headroom({}) is None


class Scheduler:
    def __init__(self, rows, fail=None):
        self.rows, self.fail = dict(rows), fail

    def all(self):
        return dict(self.rows)

    def set(self, name, cron, zone):
        if name == self.fail:
            self.fail = None
            raise RuntimeError(name)
        self.rows[name] = (cron, zone)

    def remove(self, name):
        del self.rows[name]


def test_schedules_are_applied_whole():
    s = Scheduler({"old": ("* * * * *", "UTC")})
    apply_schedules(s, {"a": "1 * * * *"}, "UTC")
    assert s.rows == {"a": ("1 * * * *", "UTC")}
    s = Scheduler({"a": ("9 * * * *", "UTC")}, fail="c")
    with pytest.raises(RuntimeError):
        apply_schedules(s, {"a": "1 * * * *", "b": "2 * * * *", "c": "3 * * * *"}, "UTC")
    assert s.rows == {"a": ("9 * * * *", "UTC")}


def test_embedding_projection_and_export(spark, tmp_path):
    docs = spark.createDataFrame([("d1", "ab"), ("d2", None)], "id string, body string")
    rows = insight.embedded(docs, lambda texts: [[len(t), 1] for t in texts], "m", "2025-01-01 00:00:00").collect()
    assert {r.document_id: r.vector for r in rows} == {"d1": [2.0, 1.0], "d2": [0.0, 1.0]} and len({r.id for r in rows}) == 2
    assert insight.cost_projection(spark.createDataFrame([(100,), (300,)], "tokens long"), 50_000, "0.5").first()[0] == 5.0 and insight.cost_projection(spark.createDataFrame([], "tokens long"), 9, "0.5").first()[0] == 0
    seen = spark.createDataFrame([("h", 1, 5), ("h", 2, None), ("k", 1, None)], "g string, o int, v int")
    assert {r.g: r.v for r in insight.last_known(seen, "g", "o", "v").collect()} == {"h": 5, "k": None}
    insight.export(docs, f"{tmp_path}/out")
    assert spark.read.option("header", True).csv(f"{tmp_path}/out").count() == 2
    assert insight.markdown(docs).splitlines()[0] == "| id | body |"
