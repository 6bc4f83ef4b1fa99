"""Whole reads of the three source shapes, from captured responses to documents and a report on coverage.

Captures are tables of what the services answered. Calls themselves stay with the caller: a task that is tried again
must not call again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidora.functions.columns import iso_ms, pair_key
from evidora.operators import normalize, tree, windows


def search(hits: DataFrame, items: DataFrame, bounds: tuple[int, int, bool], page_hits: int = windows.PAGE_HITS, pages: int = windows.PAGES) -> tuple[DataFrame, DataFrame]:
    """Documents, and the report (boundary, cursor, truncated) of one windowed read over several queries.

    ``hits``: query_idx, hit_id, at (seconds); ``items``: hit_id, status, body. A capped query reads its oldest pages.
    Boundaries come from all hits read, those seen in another query included; each hit is looked up once.
    """
    since, until, _ = bounds
    inside = hits.filter(windows.in_window(F.col("at"), bounds))
    read = windows.oldest_pages(windows.paged(inside, "query_idx", "at", "hit_id", page_hits), pages)
    limits = windows.boundaries(read, "query_idx", "at", F.lit(since).cast("long"), F.lit(until).cast("long"))
    once = windows.unique_hits(read, "hit_id", ["query_idx", "page", "at"])
    looked = normalize.items(once.select("hit_id", "at").join(items, "hit_id", "left").withColumn("status", F.coalesce("status", F.lit(599))))
    documents = looked.filter("outcome = 'document'").select(*normalize.DOCUMENT_COLUMNS)
    one = F.lit(0).alias("read")
    full = limits.select(one, "boundary", "stalled").unionByName(_row(limits, until))
    report = windows.confirmed(looked.select(one, "at", "outcome"), full, "at", F.lit(since), ["read"]).drop("read")
    return documents, report


def _row(like: DataFrame, until: int) -> DataFrame:
    """A query without hits covers the whole window."""
    return like.sparkSession.range(1).select(F.lit(0).alias("read"), F.lit(until).cast("long").alias("boundary"), F.lit(False).alias("stalled"))


def feed(pages: DataFrame, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents and new marks of an incremental read of review feeds.

    ``pages``: ordinal (of the pair), app_id, territory, page, status, body; ``marks``: pair, mark (fixed-width ISO).
    A pair with a failed page ends the read: its rows are dropped, its mark stays, later pairs are not attempted.
    The result's second frame has pair, mark and failed for the pairs that were attempted.
    """
    bad = (F.col("status") != 200) | (~F.coalesce(normalize.kind_of(F.try_parse_json("body"), "$.feed") == "OBJECT", F.lit(False)))
    failed = pages.filter(bad).agg(F.min("ordinal").alias("_failed"))
    known = pages.withColumn("pair", pair_key(F.col("app_id"), F.col("territory"))).join(F.broadcast(failed))  # one row
    tried = known.filter(F.col("_failed").isNull() | (F.col("ordinal") <= F.col("_failed"))).withColumn("failed", F.coalesce(F.col("ordinal") == F.col("_failed"), F.lit(False))).drop("_failed")
    good = tried.filter(~F.col("failed")).drop("failed", "status")
    entries = normalize.feed_entries(good).filter("entry IS NOT NULL").drop("usable")
    readable = normalize.reviews(entries).filter("reject IS NULL").withColumn("iso", iso_ms(F.col("created_at")))
    marked = readable.join(marks.select("pair", F.col("mark").alias("_mark")), "pair", "left")
    fresh = windows.until_mark(marked, ["pair"], ["page", "pos"], "iso", F.col("_mark"))
    newest = windows.newest_seen(marked, ["pair"], ["page", "pos"], "iso", F.col("_mark"))
    attempted = tried.select("pair", "failed").distinct()
    report = attempted.join(newest.withColumnRenamed("mark", "_new"), "pair", "left").join(marks, "pair", "left")
    return fresh.select(*normalize.DOCUMENT_COLUMNS), report.select("pair", F.coalesce("_new", "mark").alias("mark"), "failed")


def listing(pages: DataFrame, threads: DataFrame, least: int = tree.MIN_COMMENTS, depth: int = tree.MAX_DEPTH, breadth: int = tree.MAX_BREADTH) -> tuple[DataFrame, DataFrame]:
    """Documents (posts, then comments of threads that qualify), and per listing page what of it could be read.

    ``pages``: page, body; ``threads``: thread (the post's id), status, body. Threads that are gone (403, 404) are empty.
    The report has after, posts, unmapped, comments, unmapped_comments, truncated and failed; a failure hides truncation.
    """
    children = normalize.listing_children(pages)
    posts = normalize.posts(children.filter("data IS NOT NULL"))
    mapped = posts.filter("mapped")
    wanted = tree.qualifying(mapped).filter(F.col("num_comments") >= least).select("page", F.col("post_id").alias("thread"), "permalink")
    met = wanted.join(threads, "thread", "left")
    usable = F.coalesce(normalize.kind_of(F.try_parse_json("body"), "$[1].data.children") == "ARRAY", F.lit(False))
    gone = F.coalesce(F.col("status").isin(403, 404), F.lit(False))
    walked = tree.walk_threads(met.filter(F.col("status") == 200).select("thread", "body", "permalink"), depth=depth, breadth=breadth)
    columns = list(normalize.DOCUMENT_COLUMNS)
    documents = mapped.select(*columns).unionByName(walked.filter("mapped").select(*columns))
    of_page = walked.join(wanted.select("page", "thread"), "thread").groupBy("page").agg(F.count_if("mapped").alias("comments"), F.count_if(~F.col("mapped")).alias("unmapped_comments"))
    bad = met.groupBy("page").agg(F.count_if(~gone & ~((F.col("status") == 200) & usable)).alias("bad"))
    first = children.groupBy("page").agg(F.max("after").alias("after"), F.max("child_count").alias("children"), F.min("usable").alias("usable"))
    tried = posts.groupBy("page").agg(F.count_if("mapped").alias("posts"))
    joined = first.join(tried, "page", "left").join(of_page, "page", "left").join(bad, "page", "left").fillna(0, ["posts", "comments", "unmapped_comments", "bad"])
    failed = (F.col("bad") > 0) | ~F.coalesce("usable", F.lit(False))
    unmapped = F.col("children") - F.col("posts")
    short = normalize.shortfall(unmapped, F.col("children")) | normalize.shortfall(F.col("unmapped_comments"), F.col("comments") + F.col("unmapped_comments"))
    return documents, joined.select("page", "after", "posts", unmapped.alias("unmapped"), "comments", "unmapped_comments", (short & ~failed).alias("truncated"), failed.alias("failed"))
