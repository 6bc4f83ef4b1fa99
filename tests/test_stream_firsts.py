"""First arrivals by keyed state: late rows, replay, restart, and what state holds."""

import datetime
import time

from evidora.operators.store import first_arrivals as batch_form
from evidora.schemas import DOCUMENT, create_tables
from evidora.streaming.firsts import ingest_firsts
from evidora.streaming.ingest import captured

OLD = datetime.datetime(2025, 1, 1)


def row(ident, at, body="b", source="hackernews"):
    return (source, ident, "u", None, None, body, at, "{}", "{}")


def land(spark, rows, folder):
    spark.createDataFrame(rows, DOCUMENT.__class__([f.__class__(f.name, f.dataType, True) for f in DOCUMENT.fields])).coalesce(1).write.mode("append").json(folder)


def run_until(query, done, seconds=90):
    try:
        end = time.time() + seconds
        while time.time() < end and not done():
            assert query.exception() is None
            time.sleep(0.5)
        assert done()
    finally:
        query.stop()


def test_late_rows_are_kept_new_ones_wait_and_a_restart_inserts_nothing(spark, tmp_path):
    create_tables(spark, str(tmp_path))
    table, landing, check = (f"{tmp_path}/{n}" for n in ("documents", "landing", "check"))

    def bodies():
        return {r.source_id: r.body for r in spark.read.parquet(table).collect()}

    def start(name):
        return ingest_firsts(captured(spark, landing, 100), table, check, name, "1 second", lag_s=12)

    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    first = [row("1", OLD, "x"), row("1", OLD, "a"), row("2", OLD), row(None, OLD), row("new", now, "first"), row("untimed", None)]
    land(spark, first, landing)
    seen_early = []

    def early():
        found = bodies()
        seen_early.append("new" in found)
        return {"1", "2"} <= set(found)

    run_until(start("firsts-1"), early)
    assert not any(seen_early) or time.time() - now.replace(tzinfo=datetime.timezone.utc).timestamp() >= 12
    # a later version of a held key, one of a sent key, and a row older than all before it
    land(spark, [row("new", now, "second"), row("1", OLD, "z"), row("late", datetime.datetime(2020, 1, 1))], landing)
    run_until(start("firsts-2"), lambda: {"new", "late"} <= set(bodies()))
    assert bodies() == {"1": "a", "2": "b", "new": "first", "late": "b", "untimed": "b"}
    before = spark.read.parquet(table).count()
    land(spark, first, landing)  # the same again
    query = start("firsts-3")
    run_until(query, lambda: query.lastProgress is not None and any(p.numInputRows for p in query.recentProgress))
    assert spark.read.parquet(table).count() == before
    offered = spark.createDataFrame(first[:3], DOCUMENT)
    assert {r.source_id: r.body for r in batch_form(offered, ["created_at", "body"]).collect()} == {"1": "a", "2": "b"}
