import datetime
import os
import signal
import subprocess
import sys
import threading
import time

import pytest
from pyspark.sql import functions as F

from evidora.operators import commits, store
from evidora.operators.lease import Lease
from evidora.schemas import create_tables
from evidora.sources.stored import StoredDocuments

FIELDS = "source string, source_id string, url string, author_handle string, title string, body string, created_at timestamp, engagement string, raw string"
AT = "2025-02-01 00:00:00"


def offered(spark, low, high, source="reddit", body="b", parts=3):
    """Documents ``low`` to ``high`` - 1, one a minute."""
    n = F.col("id")
    day = F.timestamp_seconds(F.lit(1_735_689_600) + n * 60)
    return spark.range(low, high, 1, parts).select(F.lit(source).alias("source"), n.cast("string").alias("source_id"), F.lit("u").alias("url"), F.lit(None).cast("string").alias("author_handle"),
                                                   F.lit(None).cast("string").alias("title"), F.lit(body).alias("body"), day.alias("created_at"), F.lit("{}").alias("engagement"), F.lit("{}").alias("raw"))


@pytest.fixture
def path(spark, tmp_path):
    create_tables(spark, str(tmp_path))
    return f"{tmp_path}/documents"


def put(frame, path):
    return store.append(frame, path, ["source_id", "body"], AT)


def keys(frame):
    return sorted((r.source, int(r.source_id)) for r in frame.select("source", "source_id").collect())


def test_snapshots_by_number(spark, path):
    assert put(offered(spark, 0, 10), path) == 10 and put(offered(spark, 5, 25), path) == 15 and put(offered(spark, 0, 25), path) == 0
    log = commits.Log(spark, path)
    assert log.latest() == 3  # what create_tables wrote, and two commits; an append of nothing makes none
    assert [len(keys(log.snapshot(v))) for v in (1, 2, 3)] == [0, 10, 25]
    assert keys(log.snapshot()) == keys(spark.read.parquet(path)) == [("reddit", k) for k in range(25)]
    with pytest.raises(commits.ConflictError):
        log.snapshot(9)


def test_many_commits_fold_into_full_manifests(spark, path, monkeypatch):
    monkeypatch.setattr(commits, "FULL", 4)
    for k in range(9):
        assert put(offered(spark, k, k + 2, parts=1), path) == (2 if k == 0 else 1)
    log = commits.Log(spark, path)
    assert "all" in log.entry(8) and "all" not in log.entry(9) and keys(log.snapshot()) == [("reddit", k) for k in range(10)]
    assert keys(log.snapshot(6)) == [("reddit", k) for k in range(6)]


@pytest.mark.parametrize("where", ["before the manifest", "after the manifest", "while files are moved"])
def test_a_writer_that_dies_leaves_all_or_nothing(spark, path, monkeypatch, where):
    put(offered(spark, 0, 10), path)
    with monkeypatch.context() as m:
        def dies(*_):
            raise KeyboardInterrupt

        if where == "while files are moved":
            plain = commits.Files.move
            m.setattr(commits.Files, "move", lambda self, a, b: (plain(self, a, b), dies()))
        else:
            m.setattr(commits.Log, "_publish" if where.startswith("before") else "_place", dies)
        with pytest.raises(KeyboardInterrupt):
            put(offered(spark, 5, 50), path)
    log = commits.Log(spark, path)
    done = 10 if where.startswith("before") else 50
    assert len(keys(log.snapshot())) == done == len(keys(spark.read.parquet(path)))
    assert put(offered(spark, 5, 50), path) == 50 - done
    assert keys(log.snapshot()) == [("reddit", k) for k in range(50)]
    assert log.vacuum(0.0) == (1 if where.startswith("before") else 0)
    assert not [n for n in os.listdir(path) if n.startswith("_staging")] and len(keys(log.snapshot())) == 50


def test_a_number_is_given_once_and_the_loser_looks_again(spark, path, monkeypatch):
    log, plain = commits.Log(spark, path), commits.Log.commit
    log.latest()
    others = [(0, 15), (200, 210), (12, 20)]

    def commit(self, version, added, staging):
        if others:  # another writer is faster, three times
            monkeypatch.setattr(commits.Log, "commit", plain)
            put(offered(spark, *others.pop(0), body="other"), path)
            monkeypatch.setattr(commits.Log, "commit", commit)
        return plain(self, version, added, staging)

    monkeypatch.setattr(commits.Log, "commit", commit)
    assert put(offered(spark, 10, 30), path) == 10
    rows = log.snapshot()
    assert keys(rows) == [("reddit", k) for k in [*range(30), *range(200, 210)]]
    assert {int(r.source_id) for r in rows.filter("body = 'b'").collect()} == set(range(20, 30))


WRITER = """
import sys, time
sys.path[:0] = [{repo!r}, {tests!r}]
from pyspark.sql import SparkSession
from evidora.operators import store
from test_commits import offered
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "1g").getOrCreate()
k, end = {first}, time.time() + {seconds}
print("ready", flush=True)
while time.time() < end:
    print(store.append(offered(spark, k, k + 40, body="{first}"), {path!r}, ["source_id"], "2025-02-01 00:00:00", 300.0), flush=True)
    k += 20
"""


def test_processes_append_and_one_is_killed(spark, path):
    here = os.path.dirname(os.path.abspath(__file__))
    start = lambda first, seconds: subprocess.Popen([sys.executable, "-c", WRITER.format(repo=os.path.dirname(here), tests=here, first=first, seconds=seconds, path=path)], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True)
    writers = [start(0, 30), start(10, 30), start(5, 600)]
    assert all(w.stdout.readline() == "ready\n" for w in writers)
    log, seen, end = commits.Log(spark, path), [], time.time() + 60
    while time.time() < end and len({v for v, _ in seen}) < 5:  # readers see whole commits only: what one snapshot has stays, and counts are those of the manifests
        version = log.latest()
        n = log.snapshot(version).count()
        assert n == sum(f.get("rows", 0) for f in log.listed(version))
        seen.append((version, n))
    writers[2].send_signal(signal.SIGKILL)
    inserted = [[int(x) for x in w.communicate(timeout=200)[0].split()] for w in writers]
    rows = log.snapshot().select("source_id", "body").collect()
    ids = [int(r.source_id) for r in rows]
    assert len(ids) == len(set(ids)) and set(range(max(ids) // 2)) <= set(ids) and len({v for v, _ in seen}) > 2
    for first, counts in zip((0, 10), inserted, strict=False):
        assert sum(counts) == sum(r.body == str(first) for r in rows)
    assert sorted(seen) == seen and spark.read.parquet(path).count() == len(ids)


def test_a_page_of_new_keys_reads_no_file(spark, path):
    put(offered(spark, 0, 4000), path)
    put(offered(spark, 0, 4000, source="hackernews"), path)
    log = commits.Log(spark, path)
    files = log.listed()
    some = offered(spark, 0, 900).withColumn("source_id", F.concat(F.lit("1"), "source_id", F.lit("x")))  # between the bounds of ids
    assert log.may_hold(files, some) == [] and log.may_hold(files, offered(spark, 0, 5, source="appstore")) == []
    one = log.may_hold(files, offered(spark, 7, 8))
    assert len(one) == 1 < len(files) and ("reddit", 7) in keys(log.over(one))
    mixed = some.union(offered(spark, 3990, 4010))
    stored, offered_ = keys(log.over(log.may_hold(files, mixed))), {("reddit", k) for k in range(3990, 4010)}
    assert {k for k in stored if k in offered_} == {("reddit", k) for k in range(3990, 4000)}
    assert put(mixed, path) == 910


def test_large_loads_join_without_filters(spark, path, monkeypatch):
    put(offered(spark, 0, 100), path)
    monkeypatch.setattr(commits, "BLOOM_KEYS", 10)
    assert put(offered(spark, 50, 150), path) == 50 and len(keys(commits.Log(spark, path).snapshot())) == 150


def test_snapshot_reads_the_files_that_may_have_rows(spark, path):
    for k in range(4):
        put(offered(spark, 1000 * k, 1000 * k + 1000, parts=1), path)
    put(offered(spark, 0, 500, source="hackernews", parts=1), path)
    log, base = commits.Log(spark, path), datetime.datetime(2025, 1, 1)
    since, until = (base + datetime.timedelta(minutes=m) for m in (1500, 2200))
    near = log.snapshot(sources=["reddit"], since=since, until=until)
    assert len(near.inputFiles()) == 2 and keys(near) == [("reddit", k) for k in range(1500, 2201)]
    assert log.snapshot(sources=["appstore"]).count() == 0


def test_filters_reach_the_data_source(spark, path):
    for k in range(4):
        put(offered(spark, 1000 * k, 1000 * k + 1000, parts=1), path)
    put(offered(spark, 0, 500, source="hackernews", parts=1), path)
    spark.dataSource.register(StoredDocuments)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        load = lambda **o: spark.read.format("evidora_store").options(path=path, **o).load()
        every = load()
        assert every.rdd.getNumPartitions() >= 5 and sorted(every.collect()) == sorted(spark.read.parquet(path).collect())
        some = load().filter("source = 'reddit' AND created_at >= timestamp'2025-01-02 01:00:00' AND created_at < timestamp'2025-01-02 12:40:00'")
        assert some.rdd.getNumPartitions() == 2 and keys(some) == [("reddit", k) for k in range(1500, 2200)]
        assert load().filter("source IN ('hackernews', 'other')").rdd.getNumPartitions() == 1
        assert len(keys(load(version="3"))) == 2000
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_commits_as_a_stream(spark, path, tmp_path, monkeypatch):
    for k in range(3):
        put(offered(spark, 100 * k, 100 * k + 100), path)
    spark.dataSource.register(StoredDocuments)
    batches: list = []

    def run():
        def seen(batch, number):
            batches.append((number, batch.rdd.getNumPartitions(), keys(batch)))
        load = spark.readStream.format("evidora_store").option("path", path).load()
        query = load.writeStream.foreachBatch(seen).option("checkpointLocation", f"{tmp_path}/check").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    run()
    assert max(n for _, n, _ in batches) >= 3 and sorted(sum((k for *_, k in batches), [])) == [("reddit", k) for k in range(300)]
    batches.clear()
    run()  # another start: nothing twice
    assert not any(k for *_, k in batches)
    put(offered(spark, 250, 350), path)
    with monkeypatch.context() as m:  # a commit whose files are not in place waits
        m.setattr(commits.Log, "_place", lambda *_: None)
        put(offered(spark, 400, 410), path)
    run()
    assert sorted(sum((k for *_, k in batches), [])) == [("reddit", k) for k in range(300, 350)]
    commits.Log(spark, path).latest()
    run()
    assert sorted(sum((k for *_, k in batches), [])) == [("reddit", k) for k in [*range(300, 350), *range(400, 410)]]


def test_create_once_elsewhere(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits.Files, "local", lambda self: False)
    files = commits.Files(spark, str(tmp_path))
    assert files.create_once("a/b", "one") and not files.create_once("a/b", "two") and files.read("a/b") == "one" and list(files.names("a")) == ["b"]


def test_many_threads_get_one_number(spark, tmp_path):
    files, won = commits.Files(spark, str(tmp_path)), []
    threads = [threading.Thread(target=lambda k=k: files.create_once("n", str(k)) and won.append(k)) for k in range(16)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and files.read("n") == str(won[0])


def test_a_fresh_lease_is_never_stolen(spark, tmp_path):
    """B finds an old term expired; before B acts, A takes the lease over. B must not get it, nor keep A's alive or end it."""
    first, a, b = (Lease(spark, str(tmp_path), "reddit", seconds=0.3) for _ in range(3))
    assert first.acquire()
    time.sleep(0.5)
    seen = b._terms()
    b._terms = lambda: seen  # what B has read before A acted
    assert a.acquire() and a.term == 2
    assert not b.acquire()
    del b._terms
    assert a.held() and not b.held() and not first.held()
    assert not first.beat() and not b.beat() and a.beat()
    first.release()
    assert a.held()
    time.sleep(0.5)
    assert b.acquire() and b.term == 3 and not a.held() and not a.beat()
    b.release()
    assert a.acquire() and a.term == 4
