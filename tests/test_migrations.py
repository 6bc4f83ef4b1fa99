"""Forward-only versions: applied once, unchanged, in order; added columns over old and new files; a log over them."""

import threading

import pytest

from evidora.operators import migrations
from evidora.operators.commits import Log
from evidora.operators.migrations import MigrationError, Step
from evidora.schemas import DOCUMENT, TABLES

FIRST = Step("tables", creates=TABLES)
SECOND = Step("language", adds={"documents": {"lang": "string", "scores": "array<double>"}})


def document(ident):
    return ("reddit", ident, "u", None, None, "b", None, "{}", "{}")


def test_steps_are_applied_once_and_in_order(spark, tmp_path):
    base = str(tmp_path)
    assert migrations.version(spark, base) == 0
    assert migrations.migrate(spark, base, [FIRST]) == ["tables"] and migrations.migrate(spark, base, [FIRST]) == []
    assert migrations.read(spark, base, "documents", [FIRST]).columns == TABLES["documents"].names
    spark.createDataFrame([("i", "r", "1")], "id string, source string, source_id string").write.mode("append").parquet(f"{base}/documents")
    assert migrations.migrate(spark, base, [FIRST, SECOND]) == ["language"] and migrations.version(spark, base) == 2
    spark.createDataFrame([("j", "r", "2", "de", [1.0])], "id string, source string, source_id string, lang string, scores array<double>").write.mode("append").parquet(f"{base}/documents")
    rows = migrations.read(spark, base, "documents", [FIRST, SECOND]).select("id", "lang", "scores").collect()
    assert sorted(map(tuple, rows)) == [("i", None, None), ("j", "de", [1.0])]


def test_changed_missing_and_unsound_steps_are_errors(spark, tmp_path):
    base = str(tmp_path)
    migrations.migrate(spark, base, [FIRST, SECOND])
    for steps in ([FIRST], [FIRST, Step("language", adds={"documents": {"lang": "int"}})], [SECOND, FIRST]):
        with pytest.raises(MigrationError):
            migrations.migrate(spark, base, steps)
    for third in (Step("again", adds={"documents": {"lang": "string"}}), Step("none", adds={"nothing": {"a": "int"}}), Step("twice", creates={"runs": TABLES["runs"]})):
        with pytest.raises(MigrationError):
            migrations.migrate(spark, base, [FIRST, SECOND, third])
    assert migrations.version(spark, base) == 2
    (tmp_path / "_versions" / "000001.json").unlink()
    with pytest.raises(MigrationError):
        migrations.version(spark, base)


def test_two_at_once(spark, tmp_path):
    base, failed = str(tmp_path), []

    def run():
        try:
            migrations.migrate(spark, base, [FIRST, SECOND])
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    threads = [threading.Thread(target=run) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and migrations.version(spark, base) == 2
    assert migrations.read(spark, base, "documents", [FIRST, SECOND]).isEmpty()


def test_a_log_reads_old_commits_with_new_columns(spark, tmp_path):
    base = str(tmp_path)
    steps = [Step("documents", creates={"documents": DOCUMENT}), Step("language", adds={"documents": {"lang": "string"}})]
    migrations.migrate(spark, base, steps[:1])
    take = lambda rows, stored: rows.join(stored.select("source", "source_id"), ["source", "source_id"], "left_anti")
    old = spark.createDataFrame([document("1")], "source string, source_id string, url string, author_handle string, title string, body string, created_at timestamp, engagement string, raw string")
    assert Log(spark, f"{base}/documents").append(old, take) == 1
    migrations.migrate(spark, base, steps)
    log = Log(spark, f"{base}/documents", schema=migrations.schema_at(steps, "documents"))
    both = old.union(old.selectExpr("source", "'2'", *old.columns[2:])).selectExpr("*", "'de' AS lang")
    assert log.append(both, take) == 1
    assert sorted((r.source_id, r.lang) for r in log.snapshot().collect()) == [("1", None), ("2", "de")]
