"""Ingest runs: pages to stop reasons, source statuses and run status; as plans over a page log, and as a loop on the driver."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidora.errors import ConfigError, record
from evidora.schemas import SOURCES

#: Pages a source may take in a run, and the words for how a source or a run ends.
MAX_PAGES = 25
USABLE = ("complete", "partial")
NOT_ATTEMPTED = ("skipped", "not-attempted")


def _read(log: DataFrame, max_pages: int, groups: tuple[str, ...]) -> DataFrame:
    """The pages of ``log`` down to the one that ends the loop, with ``_why`` it ends there.

    A repeat of the given cursor with a partial outcome stalls, no next cursor exhausts, a repeat makes no progress.
    """
    repeated = F.col("next") == F.col("given")
    why = (F.when(repeated & F.col("partial"), "stalled").when(F.col("next").isNull(), "exhausted")
           .when(repeated & (F.col("offered") > 0), "no-progress-with-documents").when(repeated, "no-progress"))
    read = log.filter(F.col("page") <= max_pages).withColumn("_why", why)
    ended = F.min(F.when(F.col("_why").isNotNull(), F.col("page"))).over(Window.partitionBy(*groups))
    return read.withColumn("_end", ended).filter(F.col("_end").isNull() | (F.col("page") <= F.col("_end"))).drop("_end")


def counters(log: DataFrame, max_pages: int = MAX_PAGES, groups: tuple[str, ...] = ("run", "source")) -> DataFrame:
    """Per source the pages read, the rows fetched, and the reasons (``truncated`` of a page) in page order; ``max_pages`` rows each."""
    used = _read(log, max_pages, groups)
    reasons = F.sort_array(F.collect_list(F.when(F.col("truncated").isNotNull(), F.struct("page", "truncated"))))
    return used.groupBy(*groups).agg(F.count("*").alias("pages"), F.sum("offered").alias("fetched"), F.transform(reasons, lambda x: x["truncated"]).alias("truncated_reasons"))


def stop_reasons(log: DataFrame, max_pages: int = MAX_PAGES, groups: tuple[str, ...] = ("run", "source")) -> DataFrame:
    """Per source how its pages ended, from a log of them: page (from 1), given, next (cursors), offered, partial.

    The first page that ends the loop decides (_read). A source none of whose pages ends it has met the page limit.
    """
    used = _read(log, max_pages, groups)
    counted = used.groupBy(*groups).agg(
        F.count("*").alias("pages"), F.sum("offered").alias("fetched"), F.max("partial").alias("_partial"), F.max("_why").alias("_why"))
    stop = F.coalesce("_why", F.lit("page-limit"))
    status = F.when(stop == "stalled", "stalled").when(F.col("_partial"), "partial").otherwise("complete")
    return counted.select(*groups, "pages", "fetched", stop.alias("stop_reason"), status.alias("status"))


def run_status(statuses: DataFrame, groups: tuple[str, ...] = ("run",)) -> DataFrame:
    """Per run: COMPLETE where every attempted source is complete (or none was attempted), FAILED where none is usable, else PARTIAL."""
    attempted, usable = ~F.col("status").isin(*NOT_ATTEMPTED), F.col("status").isin(*USABLE)
    n = statuses.groupBy(*groups).agg(F.count_if(attempted).alias("a"), F.count_if(usable).alias("u"), F.count_if(F.col("status") == "complete").alias("c"))
    return n.select(*groups, F.when(F.col("a") == 0, "COMPLETE").when(F.col("u") == 0, "FAILED").when(F.col("c") == F.col("a"), "COMPLETE").otherwise("PARTIAL").alias("run_status"))


def every_source(counts: DataFrame, skipped: DataFrame, spark: SparkSession) -> DataFrame:
    """One row a known source, in their order: its counts, else skipped with the reason, else not attempted."""
    known = spark.createDataFrame(list(enumerate(SOURCES)), "ordinal long, source string")
    both = known.join(counts, "source", "left").join(skipped, "source", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("fetched", "inserted", "duplicates")]
    status = F.coalesce("status", F.when(F.col("reason").isNotNull(), "skipped").otherwise("not-attempted"))
    return both.select("ordinal", "source", status.alias("status"), *zero, "reason")


def totals(counts: DataFrame) -> DataFrame:
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("fetched", "inserted", "duplicates")])


def retry_decision(status: Column) -> Column:
    """What a scheduled job does with a run's status."""
    return F.when(status == "FAILED", "retry").otherwise("done")


@dataclass
class Page:
    """A page of documents: rows, the cursor to go on from (None: no more), and its outcome."""

    documents: list[dict]
    cursor: str | None = None
    truncated: str | None = None
    error: BaseException | None = None  # a partial page


@dataclass
class Counts:
    source: str
    status: str = "not-attempted"
    stop_reason: str = "not-attempted"
    fetched: int = 0
    inserted: int = 0
    duplicates: int = 0
    pages: int = 0
    duration_ms: int = 0
    truncated_reasons: list[str] = field(default_factory=list)
    detail: str | None = None


@dataclass
class Report:
    run_id: str
    status: str
    sources: list[Counts]
    errors: list[dict]


def _pages(adapter, mode: str, cursor: str | None, limit: int, span) -> Iterator[tuple[str | None, Page]]:
    for _ in range(limit):
        page = adapter.incremental(cursor) if mode == "incremental" else adapter.backfill(span, cursor)
        yield cursor, page
        cursor = page.cursor


def _ending(given: str | None, page: Page) -> str | None:
    if page.cursor is None:
        return "exhausted"
    if page.cursor != given:
        return None
    if page.error is not None:
        return "stalled"
    return "no-progress-with-documents" if page.documents else "no-progress"


def ingest_source(source: str, adapter, insert: Callable[[list[dict]], int], cursors, mode: str = "incremental", span=None, max_pages: int = MAX_PAGES) -> tuple[Counts, list[dict]]:
    """Reads one source. The stored cursor is read outside its error boundary; all else that fails is data about the source."""
    counts, errors, began = Counts(source), [], time.monotonic()
    stored = cursors.get(source) if mode == "incremental" else None
    try:
        healthy, detail = adapter.health()
        if not healthy:
            counts.status, counts.detail = "unhealthy", detail
            errors.append({"source": source, "kind": "unhealthy", "name": "UnhealthySource", "code": "SOURCE_UNHEALTHY", "message": detail, "context": {}})
            return counts, errors
        counts.status, counts.stop_reason = "complete", "page-limit"
        for given, page in _pages(adapter, mode, stored, max_pages, span):
            counts.pages += 1
            counts.fetched += len(page.documents)
            inserted = insert(page.documents)  # before the outcome is looked at: a partial page's documents stay
            counts.inserted += inserted
            counts.duplicates += len(page.documents) - inserted
            if page.truncated is not None:
                counts.truncated_reasons.append(page.truncated)
            if page.error is not None:
                counts.status = "partial"
                errors.append(record(source, "partial", page.error))
            if ending := _ending(given, page):
                counts.stop_reason = ending
                if ending == "stalled":
                    counts.status = "stalled"
                    errors.append({"source": source, "kind": "stalled", "name": "StalledSource", "code": "SOURCE_STALLED", "message": f"{source} repeats a page it cannot get past", "context": {"pages": str(counts.pages)}})
                break
            if mode == "incremental":
                cursors.set(source, page.cursor)
    except Exception as error:
        counts.status, counts.stop_reason = "failed", "error"
        errors.append(record(source, "thrown", error))
    finally:
        counts.duration_ms = int(1000 * (time.monotonic() - began))
    return counts, errors


def ingest(registry, insert: Callable[[list[dict]], int], cursors, run_log, mode: str = "incremental", span=None, max_pages: int = MAX_PAGES) -> Report:
    """One run over all sources, one after the other. Every known source is reported; the run is finished whatever happens."""
    if not isinstance(max_pages, int) or isinstance(max_pages, bool) or max_pages < 1:
        raise ConfigError("max_pages must be an integer of 1 or more", max_pages=max_pages)
    run_id = run_log.start("ingest")
    found = {s: Counts(s) for s in SOURCES}
    for source, reason in registry.skipped().items():
        found[source] = Counts(source, status="skipped", detail=reason)
    errors: list[dict] = []
    status = "FAILED"
    try:
        for source in SOURCES:
            if source in registry.sources():
                found[source], new = ingest_source(source, registry.get(source), insert, cursors, mode, span, max_pages)
                errors += new
        tried = [c.status for c in found.values() if c.status not in NOT_ATTEMPTED]
        usable = [s for s in tried if s in USABLE]
        status = "COMPLETE" if all(s == "complete" for s in tried) else "PARTIAL" if usable else "FAILED"
    finally:
        run_log.finish(run_id, status, [vars(c) for c in found.values()], errors)
    return Report(run_id, status, list(found.values()), errors)
