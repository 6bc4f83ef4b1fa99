"""The append-only store: idempotent inserts, cursors, the run ledger as events, and what must always hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidora.operators.commits import Log
from evidora.schemas import document_id

KEY = ["source", "source_id"]


def first_arrivals(offered: DataFrame, order: list[str], key: list[str] = KEY) -> DataFrame:
    """One row a key: the first in arrival order. Later versions never win, whatever they hold."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return offered.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def new_rows(offered: DataFrame, existing: DataFrame, order: list[str], key: list[str] = KEY) -> DataFrame:
    """What an insert would add: first arrivals whose key is not there yet.

    The key is all that is read of ``existing``; a small one is broadcast by its size, a large one meets by key.
    """
    return first_arrivals(offered, order, key).join(existing.select(*key), key, "left_anti")


def counts(offered: DataFrame, at: str | None = None, key: list[str] = KEY) -> DataFrame:
    """By source: rows fetched, inserted into an empty store and duplicate; with ``at`` also its first and last value.

    Two sums with map-side parts, by key and by source; no row is ranked, as only numbers are asked for.
    """
    ends = [F.min(at).alias("_a"), F.max(at).alias("_b")] if at else []
    keyed = offered.groupBy(*key).agg(F.count("*").alias("_n"), *ends)
    spans = [F.min("_a").alias(f"first_{at}"), F.max("_b").alias(f"last_{at}")] if at else []
    by_source = keyed.groupBy(key[0]).agg(F.sum("_n").alias("fetched"), F.count("*").alias("inserted"), *spans)
    return by_source.withColumn("duplicates", F.col("fetched") - F.col("inserted"))


def reported(offered: DataFrame, existing: DataFrame, key: list[str] = KEY) -> DataFrame:
    """By source what an insert into ``existing`` would report: rows fetched, inserted and duplicate.

    A row is a duplicate if its key is stored already or an earlier row has it. Keys are summed first, with map-side
    parts; then each meets the stored keys once.
    """
    keyed = offered.groupBy(*key).agg(F.count("*").alias("_n"))
    met = keyed.join(existing.select(*key).distinct().withColumn("_stored", F.lit(True)), key, "left")
    new = F.when(F.col("_stored"), 0).otherwise(1)
    return met.groupBy(key[0]).agg(F.sum("_n").alias("fetched"), F.sum(new).alias("inserted"), F.sum(F.when(F.col("_stored"), F.col("_n")).otherwise(F.col("_n") - 1)).alias("duplicates"))


def append(offered: DataFrame, path: str, order: list[str], ingested_at, wait_s: float = 600.0) -> int:
    """Inserts the new rows of ``offered`` into the documents table at ``path``; returns how many were inserted.

    One commit of the table's log (``operators.commits``): all rows or none, and no key twice, however many writers there are and
    wherever one of them dies. Files that can't hold an offered key, by their bounds and filters, are not read.
    Nothing is ever updated or deleted here.
    """
    def missing(rows: DataFrame, stored: DataFrame) -> DataFrame:
        return new_rows(rows, stored, order).withColumn("id", document_id()).withColumn("ingested_at", F.lit(ingested_at).cast("timestamp"))

    return Log(offered.sparkSession, path, tuple(KEY)).append(offered, missing, wait_s)


def seed(spark: SparkSession, files: list[str], path: str, ingested_at) -> int:
    """Loads JSON arrays of documents and inserts them; a second call inserts none."""
    schema = "source string, source_id string, url string, author_handle string, title string, body string, created_at timestamp, engagement string, raw string"
    rows = spark.read.schema(schema).option("multiLine", True).json(files)
    return append(rows, path, ["source", "source_id"], ingested_at)


def upserted(old: DataFrame, new: DataFrame, key: list[str], version: str) -> DataFrame:
    """Old and new rows, the latest version of each key (cursors: the last writer wins; of equal versions the new one)."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(version), F.desc("_new")))
    return both.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "_new")


def cursor_of(cursors: DataFrame, source: str) -> str | None:
    row = cursors.filter(F.col("source") == source).select("cursor").first()
    return row and row.cursor


def ledger(events: DataFrame) -> DataFrame:
    """The runs from their events (start, usage, finish): status, times, sums of tokens and cost.

    ``events`` has run_id, kind, at, stage, status, input_tokens, output_tokens and cost_usd. Usage adds up; each cost
    is rounded to four places once, where it is recorded.
    """
    cost = F.round(F.col("cost_usd").cast("decimal(38,12)"), 4).cast("decimal(20,4)")
    started, finished = F.col("kind") == "start", F.col("kind") == "finish"
    return events.groupBy("run_id").agg(
        F.max(F.when(started, F.col("stage"))).alias("stage"),
        F.coalesce(F.max_by(F.when(finished, F.col("status")), F.when(finished, F.col("at"))), F.lit("running")).alias("status"),
        F.min(F.when(started, F.col("at"))).alias("started_at"), F.max(F.when(finished, F.col("at"))).alias("finished_at"),
        F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum(cost).alias("cost_usd"),
        F.max(started).alias("has_start"))


def orphan_events(events: DataFrame) -> DataFrame:
    """Finish and usage events of runs that never started; a writer must raise if there are any."""
    return events.filter("kind <> 'start'").join(events.filter("kind = 'start'").select("run_id"), "run_id", "left_anti")


def violations(before: DataFrame, after: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Rows of ``before`` that ``after`` lacks or has changed: none, for an append-only table."""
    columns = [c for c in before.columns if c not in key]
    mark = lambda df: df.select(*key, F.xxhash64(*columns).alias("_mark"))
    return mark(before).join(mark(after), [*key, "_mark"], "left_anti").drop("_mark")


def missing_embeddings(documents: DataFrame, embeddings: DataFrame, model: str) -> DataFrame:
    """Documents that have no vector of ``model`` yet."""
    done = embeddings.filter(F.col("model") == model).select(F.col("document_id").alias("id"))
    return documents.join(done, "id", "left_anti")
