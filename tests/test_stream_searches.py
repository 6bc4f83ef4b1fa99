"""Captured searches as a stream: tasks a batch, capped ties, transient failures, holes, limits and restarts."""

import random

import pytest

from evidora.sources.searches import CapturedSearches, advanced, marks, record


def hits(*ats):
    return [{"hit_id": f"{at}-{k}", "at": at, "payload": "{}"} for k, at in enumerate(ats)]


@pytest.fixture
def stream(spark, tmp_path):
    spark.dataSource.register(CapturedSearches)
    batches = []

    def run(limit=0):
        source = spark.readStream.format("evidora_searches").option("path", f"{tmp_path}/searches")
        if limit:
            source = source.option("readsPerBatch", str(limit)).option("progress", f"{tmp_path}/progress.json")

        def keep(batch, _):
            batches.append((batch.rdd.getNumPartitions(), sorted((r.query, r.at, r.hit_id) for r in batch.collect())))

        query = source.load().writeStream.foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/check-{limit}").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return batches

    return run


def ats(batches, query="q"):
    return sorted(at for _, rows in batches for q, at, _ in rows if q == query)


def test_a_capped_tie_is_never_skipped_and_files_are_tasks(spark, tmp_path, stream):
    path = f"{tmp_path}/searches"
    record(spark, path, "q", 0, 100, [hits(40, 30), hits(30, 20), hits(10)], capped=True)  # more hits of second 40 were cut
    record(spark, path, "other", 0, 100, [hits(5, 6)])
    batches = stream()
    assert batches[0][0] == 4 and ats(batches) == [10, 20, 30, 30] and ats(batches, "other") == [5, 6]
    assert marks(spark, path) == {"q": 30, "other": 100}
    record(spark, path, "q", 30, 100, [hits(40, 40, 40, 50)])
    assert ats(stream()) == [10, 20, 30, 30, 40, 40, 40, 50]  # after a restart


def test_a_transient_failure_and_a_hole_hold_the_offset(spark, tmp_path, stream):
    path = f"{tmp_path}/searches"
    record(spark, path, "q", 0, 100, [hits(10, 20, 30)], failed_at=20)
    assert ats(stream()) == [10] and marks(spark, path) == {"q": 19}
    record(spark, path, "q", 50, 200, [hits(60)])  # begins beyond the mark
    assert ats(stream()) == [10] and marks(spark, path) == {"q": 19}
    record(spark, path, "q", 19, 200, [hits(20, 30, 60, 150)])
    assert ats(stream()) == [10, 20, 30, 60, 150]


def test_a_limit_is_kept_over_restarts(spark, tmp_path, stream):
    path = f"{tmp_path}/searches"
    for k in range(5):
        record(spark, path, "q", 10 * k, 10 * k + 10, [hits(10 * k + 1, 10 * k + 5)])
    batches = stream(limit=2)
    assert [len(rows) for _, rows in batches if rows] == [4, 4, 2]
    record(spark, path, "q", 50, 60, [hits(51)])
    assert ats(stream(limit=2)) == [v for k in range(5) for v in (10 * k + 1, 10 * k + 5)] + [51]
    with pytest.raises(Exception, match="progress"):
        spark.readStream.format("evidora_searches").option("path", path).option("readsPerBatch", "1").load().writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/x").start().awaitTermination(30)


def test_every_hit_is_given_once_whatever_is_cut(spark):
    """A source with ties read by random caps and failures: the marks cover every second once, and the last is reached."""
    rng = random.Random(7)
    for _ in range(200):
        whole = sorted(rng.randrange(1, 40) for _ in range(60))
        held, given, until = {}, [], 50
        for _ in range(400):
            since = held.get("q", 0)
            if since >= until:
                break
            window = [a for a in whole if since < a <= until]
            size = rng.randrange(20, 60)  # the oldest pages of a capped read, cut inside a second
            read, capped = window[:size], len(window) > size
            failed = rng.choice([None, None, rng.choice(read)]) if read else None
            entry = {"query": "q", "since": since, "until": until, "capped": capped, "failed_at": failed, "newest": sorted(set(read), reverse=True)[:2]}
            old, new = advanced(held, entry)
            held["q"] = new
            given += [a for a in read if old < a <= new]
        assert held["q"] == until and sorted(given) == whole
