import datetime
import time
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evidora import config, log
from evidora.errors import BudgetExceededError, ConfigError, UpstreamError, record
from evidora.operators import cost, policy, runs, store, windows
from evidora.operators.runs import Page
from evidora.schemas import REFERENCES, TABLES, create_tables, orphans, reachable
from evidora.sources import cursors
from evidora.sources.auth import Tokens
from evidora.sources.registry import PagedSource, Registry, production
from evidora.streaming.ingest import PagedStream, captured, ingest_stream


class Memory:
    """A document store, a cursor store and a run log in memory."""

    def __init__(self):
        self.keys, self.cursors, self.finished = set(), {}, []

    def insert(self, documents):
        new = {d["source_id"] for d in documents} - self.keys
        self.keys |= new
        return len(new)

    def get(self, source):
        return self.cursors.get(source)

    def set(self, source, cursor):
        self.cursors[source] = cursor

    def start(self, stage):
        return "run-1"

    def finish(self, *args):
        self.finished.append(args)


def docs(*ids):
    return [{"source_id": i, "created_at": int(i)} for i in ids]


class Scripted(PagedSource):
    def __init__(self, pages):
        self.pages = iter(pages)

    def incremental(self, cursor):
        page = next(self.pages)
        if isinstance(page, Exception):
            raise page
        return page

    def health(self):
        return True, "ok"


@pytest.mark.parametrize("pages, want", [
    ([Page(docs("1"), "a"), Page(docs("2"), None)], ("complete", "exhausted", 2)),
    ([Page(docs("1"), "a"), Page(docs("1"), "a")], ("complete", "no-progress-with-documents", 1)),
    ([Page(docs("1"), "a"), Page([], "a")], ("complete", "no-progress", 1)),
    ([Page(docs("1"), "a"), Page(docs("2"), "a", error=UpstreamError("x"))], ("stalled", "stalled", 2)),
    ([Page(docs("1"), None, error=UpstreamError("x"))], ("partial", "exhausted", 1)),
    ([Page(docs("1"), "a", truncated="cap"), Page(docs("2"), "b"), Page(docs("3"), "c"), Page([], None)], ("complete", "page-limit", 3)),
    ([Page(docs("1"), "a"), RuntimeError("boom")], ("failed", "error", 1)),
])
def test_how_a_source_ends(pages, want):
    m = Memory()
    counts, errors = runs.ingest_source("hackernews", Scripted(pages), m.insert, m, max_pages=3)
    assert (counts.status, counts.stop_reason, counts.inserted) == want
    assert counts.inserted + counts.duplicates <= counts.fetched
    assert all("stack" not in e for e in errors)


def test_a_run(spark):
    m = Memory()
    registry = Registry.of([("hackernews", PagedSource([docs("1", "2"), docs("2", "3")])), ("appstore", PagedSource([], healthy=False, detail="down"))], {"reddit": "no credentials"})
    report = runs.ingest(registry, m.insert, m, m)
    assert report.status == "PARTIAL" and [c.status for c in report.sources] == ["complete", "unhealthy", "skipped"]
    assert (report.sources[0].fetched, report.sources[0].inserted, report.sources[0].duplicates) == (4, 3, 1) and m.cursors == {"hackernews": "1"}
    again = runs.ingest(registry.only("hackernews"), m.insert, Memory(), m)
    assert again.status == "COMPLETE" and again.sources[0].inserted == 0 and [c.status for c in again.sources] == ["complete", "skipped", "skipped"]
    span = runs.ingest(registry.only("hackernews"), Memory().insert, m, m, "backfill", (2, 3))
    assert span.sources[0].fetched == 3 and len(m.finished) == 3
    for bad in (0, 1.5, True):
        with pytest.raises(ConfigError):
            runs.ingest(registry, m.insert, m, m, max_pages=bad)

    class Broken(Memory):
        def get(self, source):
            raise RuntimeError("store")

    with pytest.raises(RuntimeError):
        runs.ingest(registry, m.insert, Broken(), m)
    assert m.finished[-1][1] == "FAILED"


def test_registry_and_cursors():
    with pytest.raises(ConfigError):
        Registry({"other": PagedSource([])})
    with pytest.raises(ConfigError):
        Registry.of([("reddit", PagedSource([])), ("reddit", PagedSource([]))])
    with pytest.raises(ConfigError):
        Registry({"reddit": PagedSource([])}, {"reddit": "x"})
    with pytest.raises(ConfigError):
        Registry({}).get("reddit")
    assert production({"reddit": PagedSource([]), "hackernews": PagedSource([])}, False).skipped() == {"reddit": "credentials are not configured"}
    assert cursors.read_marks("no json") == {} and cursors.read_marks('{"a":"x","b":5}') == {"a": "x"} and cursors.read_marks(cursors.write_marks({"p:us": "t"})) == {"p:us": "t"}
    names = ["x", "y"]
    assert cursors.read_position(None, names) == (0, None)
    place = cursors.next_position(names, 1, None, None, False)
    assert cursors.read_position(place, names) == (2, None) and cursors.read_position(place, ["z"]) == (0, None) and cursors.read_position(place, ["y", "x"]) == (0, None)
    assert cursors.read_position(cursors.next_position(names, 1, "g", "n", False), names) == (1, "n") and cursors.read_position(cursors.next_position(names, 1, "g", "n", True), names) == (1, "g")
    assert cursors.next_position(names, 3, None, None, False) is None
    for bad in ("{", '{"subreddit":"x","after":null}', '{"subreddit":"x","listing":"new","after":5}', "[]"):
        with pytest.raises(ConfigError):
            cursors.read_position(bad, names)


def test_windows():
    now = 1_000_000
    assert windows.window("incremental", now) == (now - 86400, now - 60, True) and windows.window("incremental", now, cursor=now - 100) == (now - 100, now - 60, False)
    assert windows.window("incremental", now, cursor=now - 60) is None and windows.window("backfill", since=5, until=9) == (5, 9, True) and windows.window("backfill", since=5, until=9, cursor=9) is None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), min_size=1, max_size=25))
def test_first_arrival_wins(spark, offers):
    rows = [(k, s, i, f"v{k}") for k, (s, i) in enumerate(offers)]
    frame = spark.createDataFrame(rows, "pos int, source int, source_id int, body string")
    first = {}
    for _, s, i, v in rows:
        first.setdefault((s, i), v)
    assert {(r.source, r.source_id): r.body for r in store.first_arrivals(frame, ["pos"]).collect()} == first


@pytest.mark.parametrize("seed", range(3))
def test_bucket_is_that_of_a_loop(spark, seed):
    rng = random.Random(seed)
    at = sorted(rng.randint(0, 30_000) for _ in range(200))
    level, last, want = 5.0, None, []
    for t in at:
        if last is not None and t > last:
            level = min(5.0, level + (t - last) * 5 / 6000)
        last = t
        level -= 1
        want.append(-level * 6000 / 5 if level < 0 else 0.0)
    frame = spark.createDataFrame([("h", i, t) for i, t in enumerate(at)], "host string, id long, at_ms long")
    got = [r.delay_ms for r in policy.bucket_delays(frame, 5, 6000).orderBy("id").collect()]
    assert max(abs(a - b) for a, b in zip(got, want, strict=True)) < 1e-6
    assert policy.limited(frame).filter("delay_ms > 0").isEmpty()


def test_dropped_ticks(spark):
    rows = [("a", 0, 10), ("a", 5, 50), ("a", 10, 12), ("a", 11, 90), ("a", 20, 21), ("b", 5, 6)]
    got = policy.dropped_ticks(spark.createDataFrame(rows, "source string, at long, until long")).orderBy("source", "at").collect()
    assert [r.dropped for r in got] == [False, True, False, True, False, False]


def document(i, body="b", source="hackernews"):
    return (source, str(i), "u", None, None, body, datetime.datetime(2025, 1, 1), "{}", "{}")


FIELDS = "source string, source_id string, url string, author_handle string, title string, body string, created_at timestamp, engagement string, raw string"


def test_store(spark, tmp_path):
    base = str(tmp_path)
    assert set(create_tables(spark, base)) == set(TABLES) and create_tables(spark, base) == []
    path = f"{base}/documents"
    offered = spark.createDataFrame([document(1), document(1, "later"), document(2)], FIELDS)
    assert store.append(offered, path, ["source", "source_id", "body"], "2025-01-02 00:00:00") == 2
    before = spark.createDataFrame(spark.read.parquet(path).collect(), TABLES["documents"])
    assert store.append(spark.createDataFrame([document(1, "new"), document(3)], FIELDS), path, ["source_id"], "2025-01-03 00:00:00") == 1
    after = spark.read.parquet(path)
    assert store.violations(before, after).isEmpty() and not store.violations(after, before).isEmpty()
    assert {r.source_id: r.body for r in after.collect()} == {"1": "b", "2": "b", "3": "b"}
    marks = store.upserted(spark.createDataFrame([("reddit", "a", 1)], "source string, cursor string, updated_at int"), spark.createDataFrame([("reddit", "b", 1)], "source string, cursor string, updated_at int"), ["source"], "updated_at")
    assert store.cursor_of(marks, "reddit") == "b" and store.cursor_of(marks, "appstore") is None
    points = spark.createDataFrame([("p", [after.first().id, "gone"])], "id string, source_document_ids array<string>")
    assert [r.id for r in orphans(points, "source_document_ids", after).collect()] == ["p"] and orphans(points, "source_document_ids", after.select("id").union(spark.createDataFrame([("gone",)], "id string"))).isEmpty()
    assert {r.name for r in reachable(spark).collect()} == {t for t, _ in REFERENCES}


def test_overlapping_appends(spark, tmp_path):
    import threading

    create_tables(spark, str(tmp_path))
    path = f"{tmp_path}/documents"
    offered = [spark.createDataFrame([document(i, f"from {k}") for i in range(k, k + 20)], FIELDS) for k in (0, 10)]
    counts: list = [None, None]
    threads = [threading.Thread(target=lambda k=k: counts.__setitem__(k, store.append(offered[k], path, ["source_id"], "2025-01-02 00:00:00"))) for k in (0, 1)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    rows = spark.read.parquet(path)
    assert sum(counts) == 30 == rows.count() == rows.select("source", "source_id").distinct().count()
    assert not [p for p in (tmp_path / "documents").iterdir() if p.name.startswith("_staging")]


def test_leases(spark, tmp_path):
    from evidora.operators.lease import Lease, LeaseHeldError

    folder = str(tmp_path)
    one, two = Lease(spark, folder, "hackernews", seconds=0.4, beat_s=0.1), Lease(spark, folder, "hackernews", seconds=0.4)
    with one:
        time.sleep(0.8)  # renewed meanwhile
        assert not two.acquire() and one.held()
        with pytest.raises(LeaseHeldError):
            two.__enter__()
    assert two.acquire() and not one.held()
    time.sleep(0.8)  # not renewed: another may take over, and the old owner can't release it
    three = Lease(spark, folder, "hackernews", seconds=0.4)
    assert three.acquire() and not two.held()
    two.release()
    assert three.held()
    three.release()
    assert Lease(spark, folder, "hackernews").acquire()


def test_streams(spark, tmp_path):
    table, landing = f"{tmp_path}/documents", f"{tmp_path}/landing"
    create_tables(spark, str(tmp_path))
    spark.createDataFrame([document(i) for i in range(5)], FIELDS).coalesce(1).write.json(landing)
    for expected in (5, 5):
        ingest_stream(captured(spark, landing), table, f"{tmp_path}/check", "hackernews", "2025-01-02 00:00:00").awaitTermination(60)
        assert spark.read.parquet(table).count() == expected
    spark.createDataFrame([document(i) for i in range(3, 8)], FIELDS).coalesce(1).write.mode("append").json(landing)
    ingest_stream(captured(spark, landing), table, f"{tmp_path}/check", "hackernews", "2025-01-02 00:00:00").awaitTermination(60)
    assert spark.read.parquet(table).count() == 8
    spark.dataSource.register(PagedStream)
    q = spark.readStream.format("evidora_pages").option("pages", '[[["s","1","a"]],[["s","1","b"],["s","2","c"]]]').load().writeStream.format("memory").queryName("paged").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted((r.page, r.pos, r.source_id, r.body) for r in spark.table("paged").collect()) == [(0, 0, "1", "a"), (1, 0, "1", "b"), (1, 1, "2", "c")]


def test_seed(spark, tmp_path):
    create_tables(spark, str(tmp_path))
    file = tmp_path / "seed.json"
    file.write_text('[{"source":"reddit","source_id":"1","url":"u","body":"b","created_at":"2025-01-01T00:00:00.000Z","engagement":{"a":1},"raw":{"x":[1]}}]')
    assert [store.seed(spark, [str(file)], f"{tmp_path}/documents", "2025-01-02 00:00:00") for _ in range(2)] == [1, 0]
    row = spark.read.parquet(f"{tmp_path}/documents").first()
    assert row.engagement == '{"a":1}' and row.raw == '{"x":[1]}' and row.ingested_at == datetime.datetime(2025, 1, 2)


def test_extract(spark):
    asked = spark.createDataFrame([(0, "a", "p", 10), (1, "b", "pp", 10), (2, "c", "p", 10)], "ordinal long, custom_id string, prompt string, max_tokens long")
    used = []
    client = cost.Client(lambda rows: [("a", 0, "succeeded", 100, 50), ("b", 0, "errored", 5, 5), ("a", 1, "succeeded", 200, 50)], len)
    got = cost.extract(asked, client, "batch", lambda: 0.0, lambda *x: used.append(x)).orderBy("ordinal").collect()
    assert [(r.type, r.error, r.input_tokens) for r in got] == [("succeeded", None, 200), ("errored", None, 0), ("expired", "missing_result", 0)] and used == [(200, 50, round((200 * 0.5 + 50 * 2.5) / 1e6, 4))]
    assert cost.extract(asked.limit(0), client, "batch", lambda: 0.0, used.append) is None
    with pytest.raises(BudgetExceededError):
        cost.extract(asked, client, "batch", lambda: 70.0, used.append)
    with pytest.raises(ConfigError):
        cost.allowed("other")


def test_config_log_and_tokens():
    good = config.load({"DATABASE_URL": "postgres://u:p@h/db", "REDDIT_SUBREDDITS": " a, b ", "LLM_API_KEY": "k"})
    assert good.numbers["BUDGET_CEILING_USD"] == 70 and good.lists["REDDIT_SUBREDDITS"] == ("a", "b") and "postgres" not in repr(good) and good.redacted()["DATABASE_URL"] == "[redacted]" and config.warnings(good)
    with pytest.raises(ConfigError) as error:
        config.load({"BUDGET_CEILING_USD": "x", "MAX_PAGES_PER_RUN": "0", "CRON_REDDIT": "* *", "SCHEDULE_TZ": "Mars/Base"})
    assert len(error.value.context["problems"]) == 5
    assert '"run_id"' not in log.line("info", "x", run_id="fake") and '"level": "info"' in log.line("info", "x", level="spoof")
    with log.run("r1"):
        assert '"run_id": "r1"' in log.line("warn", "x", error=UpstreamError("bad", url="u"))
    assert record("reddit", "thrown", "text")["name"] == "UnknownThrownValue" and record(None, "thrown", UpstreamError("m", a=1)) == {"source": None, "kind": "thrown", "name": "UpstreamError", "code": "UPSTREAM", "message": "m", "context": {"a": "1"}}
    now, minted = [0.0], []
    tokens = Tokens("i", "s", lambda basic: (minted.append(basic), (200, {"access_token": f"t{len(minted)}", "expires_in": 100}))[1], lambda: now[0])
    assert tokens.get() == tokens.get() == "t1"
    now[0] = 71
    assert tokens.get() == "t2"
    assert tokens.request(lambda t: (401, t))[1] == "t3" and len(minted) == 3
    with pytest.raises(ConfigError):
        Tokens("i", "s", lambda basic: (500, {}), lambda: 0.0).get()


def test_set_status_is_that_of_the_loop(spark):
    cases = [["complete", "skipped"], ["complete", "failed"], ["stalled", "unhealthy"], ["skipped", "not-attempted"], ["partial"]]
    rows = spark.createDataFrame([(k, s) for k, x in enumerate(cases) for s in x], "run int, status string")
    assert [r.run_status for r in runs.run_status(rows).orderBy("run").collect()] == ["COMPLETE", "PARTIAL", "FAILED", "COMPLETE", "PARTIAL"]
    assert runs.totals(rows.select(*[F.lit(1).alias(c) for c in ("fetched", "inserted", "duplicates")])).first().fetched == 9
