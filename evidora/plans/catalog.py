"""The registered queries over the test tables, each with SQL that says the same.

Events stand for hits (source: event_type, id: event_id), documents for themselves, conversations for comment threads
(parent of turn t: (t - 1) div 2, roots without a parent), orders for runs and calls, labels for judged rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidora.functions import columns as C
from evidora.operators import commits, cost, insight, normalize, policy, runs, store, tree, vectors, windows
from evidora.shared import folder, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

NOW = "2024-01-31 00:00:00"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark, sf_dir) -> DataFrame:
    """Events as normalised documents, with the seconds of their time."""
    e = _t(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("source"), F.col("event_id").cast("string").alias("source_id"), "event_id", "user_id", "ts", "props", "value")


_MINUTE = "(epoch(date_trunc('minute', ts))::BIGINT)"
_SECONDS = "(epoch(date_trunc('second', ts))::BIGINT)"


def _minute(col: str = "ts"):
    return F.unix_seconds(F.date_trunc("minute", F.col(col)).cast("timestamp"))


# --- normalisation -------------------------------------------------------------------------------------------------

@query("""SELECT event_type AS source, CAST(event_id AS VARCHAR) AS source_id, 'https://example.com/item?id=' || event_id AS url,
  CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'u/' || user_id END AS author_handle,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS created_at FROM events""")
def normalize_events(spark, sf_dir):
    e = _events(spark, sf_dir)
    author = F.when(F.col("user_id") % 10 == 0, "[deleted]").otherwise(F.col("user_id").cast("string"))
    return e.select("source", "source_id", F.concat(F.lit("https://example.com/item?id="), "source_id").alias("url"), C.prefixed_author(author).alias("author_handle"),
                    C.number_at(F.try_parse_json("props"), "$.k").cast("long").alias("k"), C.iso_ms(F.col("ts")).alias("created_at"))


@query("""SELECT event_id, CASE WHEN user_id % 10 = 0 OR user_id % 7 = 0 THEN NULL ELSE 'u/' || user_id END AS author FROM events""")
def normalize_author_null(spark, sf_dir):
    raw = F.when(F.col("user_id") % 10 == 0, "[deleted]").when(F.col("user_id") % 7 == 0, "").otherwise(F.col("user_id").cast("string"))
    return _events(spark, sf_dir).select("event_id", C.prefixed_author(raw).alias("author"))


def _item_rows(spark, sf_dir):
    """Payloads made from events: some fail, some are null, deleted, polls or have a title that is a number."""
    i, e = F.col("event_id"), _events(spark, sf_dir)
    fields = [("id", i), ("type", F.when(i % 19 == 0, "poll").when(i % 2 == 0, "story").otherwise("comment")), ("time", F.unix_seconds(F.col("ts").cast("timestamp"))),
              ("by", F.col("user_id").cast("string")), ("deleted", F.when(i % 13 == 0, F.lit(True)))]
    body = F.to_json(F.struct(*[c.alias(n) for n, c in fields]))
    body = F.when(i % 23 == 0, "null").when(i % 17 == 0, F.concat(F.lit('{"id":"'), i.cast("string"), F.lit('"}'))).otherwise(body)
    return e.select("event_id", "source", "ts", F.when(i % 11 == 0, 503).otherwise(200).alias("status"), body.alias("body"))


_CLASS = "CASE WHEN event_id % 11 = 0 THEN 'transient-failure' WHEN event_id % 23 = 0 THEN 'filtered' WHEN event_id % 17 = 0 THEN 'malformed' WHEN event_id % 13 = 0 OR event_id % 19 = 0 THEN 'filtered' ELSE 'document' END"


@query(f"SELECT event_type AS source, {_CLASS} AS outcome, count(*) AS n FROM events GROUP BY ALL")
def hydration_classes(spark, sf_dir):
    rows = _item_rows(spark, sf_dir)
    return normalize.parsed(rows, "body").select("source", normalize.hydration_class(F.col("status"), F.col("_v")).alias("outcome")).groupBy("source", "outcome").agg(F.count("*").alias("n"))


@query(f"""SELECT event_id, CAST(event_id AS VARCHAR) AS source_id, 'https://news.ycombinator.com/item?id=' || event_id AS url, CAST(user_id AS VARCHAR) AS author_handle, '' AS body,
  CASE WHEN event_id % 2 = 0 THEN '{{"points":0,"commentCount":0}}' ELSE '{{"replyCount":0}}' END AS engagement, {_SECONDS} AS created_s FROM events WHERE {_CLASS} = 'document'""")
def normalize_items(spark, sf_dir):
    done = normalize.items(_item_rows(spark, sf_dir).drop("source")).filter("outcome = 'document'")
    return done.select("event_id", "source_id", "url", "author_handle", "body", "engagement", F.unix_seconds("created_at").alias("created_s"))


@query(f"""SELECT source, bad * 2 >= bad + good AND bad > 0 AS truncated, bad, good FROM (SELECT event_type AS source, count(*) FILTER (WHERE {_CLASS} = 'malformed') AS bad,
  count(*) FILTER (WHERE {_CLASS} = 'document') AS good FROM events GROUP BY 1)""")
def malformed_ratio(spark, sf_dir):
    rows = normalize.parsed(_item_rows(spark, sf_dir), "body").select("source", normalize.hydration_class(F.col("status"), F.col("_v")).alias("c"))
    n = rows.groupBy("source").agg(F.count_if(F.col("c") == "malformed").alias("bad"), F.count_if(F.col("c") == "document").alias("good"))
    return n.select("source", normalize.shortfall(F.col("bad"), F.col("bad") + F.col("good")).alias("truncated"), "bad", "good")


def _review_rows(spark, sf_dir):
    """Feed entries made from documents: every third rating is unreadable, every fifth title blank."""
    d, i = _t(spark, sf_dir, "documents"), F.col("doc_id")
    label = lambda c: F.struct(c.alias("label"))
    rating = F.when(i % 3 == 0, "4.5").when(i % 3 == 1, " 5 ").otherwise("2")
    entry = F.struct(label(i.cast("string")).alias("id"), F.struct(label(F.col("source")).alias("name"), label(F.lit("x")).alias("uri")).alias("author"),
                     label(F.lit("2024-01-02T03:04:05-07:00")).alias("updated"), label(F.when(i % 5 == 0, " ").otherwise(F.col("lang"))).alias("title"),
                     label(F.col("lang")).alias("content"), label(rating).alias("im:rating"))
    return d.select("doc_id", F.lit("42").alias("app_id"), F.lit("us").alias("territory"), F.to_json(entry).alias("entry"))


@query("""SELECT doc_id, CAST(doc_id AS VARCHAR) AS source_id, 'https://apps.apple.com/us/app/id42?see-all=reviews' AS url, source AS author_handle,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang END AS title, '{"rating":' || (CASE WHEN doc_id % 3 = 1 THEN '5' ELSE '2' END) || ',"voteCount":0,"voteSum":0}' AS engagement,
  '2024-01-02T10:04:05.000Z' AS created_at, false AS identity_kept FROM documents WHERE doc_id % 3 <> 0""")
def normalize_reviews(spark, sf_dir):
    done = normalize.reviews(_review_rows(spark, sf_dir)).filter("reject IS NULL")
    return done.select("doc_id", "source_id", "url", "author_handle", "title", "engagement", C.iso_ms(F.col("created_at")).alias("created_at"), F.contains("raw", F.lit('"uri"')).alias("identity_kept"))


@query("SELECT CASE WHEN doc_id % 3 = 0 THEN 'rating' ELSE 'document' END AS reject, count(*) AS n FROM documents GROUP BY 1")
def review_rejects(spark, sf_dir):
    done = normalize.reviews(_review_rows(spark, sf_dir))
    return done.groupBy(F.coalesce("reject", F.lit("document")).alias("reject")).agg(F.count("*").alias("n"))


@query("""SELECT conv_id, count(*) AS posts, count(*) FILTER (WHERE turn % 4 <> 3) AS mapped, count(*) FILTER (WHERE turn % 4 = 3) * 2 >= count(*) AS truncated FROM conversations GROUP BY 1""")
def normalize_posts(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations")
    node = F.to_json(F.struct(F.col("turn").cast("string").alias("id"), F.concat(F.lit("t3_"), F.col("turn").cast("string")).alias("name"), F.lit("/r/x/1/").alias("permalink"),
                              F.when(F.col("turn") % 4 != 3, F.col("role")).alias("title"), F.col("turn").alias("created_utc")))
    mapped = normalize.posts(c.select("conv_id", node.alias("data")))
    n = mapped.groupBy("conv_id").agg(F.count("*").alias("posts"), F.count_if("mapped").alias("mapped"))
    return n.select("conv_id", "posts", "mapped", normalize.shortfall(F.col("posts") - F.col("mapped"), F.col("posts")).alias("truncated"))


# --- idempotent append, cursors, ledger ----------------------------------------------------------------------------

_PAGES = "SELECT 0 AS page, event_type AS source, event_id, ts FROM events WHERE event_id % 3 <> 0 UNION ALL SELECT 1, event_type, event_id, ts FROM events WHERE event_id % 2 = 0 OR event_id % 3 = 0"


def _two_pages(spark, sf_dir):
    """The same events offered by two overlapping pages."""
    e = _events(spark, sf_dir).select("source", "source_id", "event_id", "ts")
    return e.filter("event_id % 3 <> 0").withColumn("page", F.lit(0)).unionByName(e.filter("event_id % 2 = 0 OR event_id % 3 = 0").withColumn("page", F.lit(1)))


@query(f"SELECT source, event_id, page FROM ({_PAGES}) QUALIFY row_number() OVER (PARTITION BY source, event_id ORDER BY page) = 1")
def ingest_dedup_first_wins(spark, sf_dir):
    return store.first_arrivals(_two_pages(spark, sf_dir), ["page"]).select("source", "event_id", "page")


@query(f"""SELECT source, count(*) AS fetched, count(DISTINCT event_id) AS inserted, count(*) - count(DISTINCT event_id) AS duplicates FROM ({_PAGES}) GROUP BY 1""")
def ingest_counts_by_source(spark, sf_dir):
    return store.counts(_two_pages(spark, sf_dir))


@query(f"""SELECT 2 AS version, source, count(*) AS rows FROM ({_PAGES}) WHERE page = 0 GROUP BY 2 UNION ALL SELECT 3, event_type, count(*) FROM events GROUP BY 2""")
def store_snapshots(spark, sf_dir):
    """Two overlapping pages committed to a table one after the other, and what its snapshots hold."""
    pages = _two_pages(spark, sf_dir).withColumn("created_at", F.col("ts").cast("timestamp"))
    path = f"{folder(spark)}/snapshots-{uuid.uuid4().hex}"
    pages.filter("page < 0").write.parquet(path)
    log = commits.Log(spark, path)
    for page in (0, 1):
        log.append(pages.filter(F.col("page") == page), lambda rows, stored: store.new_rows(rows, stored, ["page"]))
    of = lambda v: log.snapshot(v).groupBy("source").agg(F.count("*").alias("rows")).select(F.lit(v).alias("version"), "source", "rows")
    return of(2).unionByName(of(3))


@query("SELECT event_type AS source, event_id FROM events WHERE event_id >= 500")
def ingest_anti_join_new(spark, sf_dir):
    e = _events(spark, sf_dir).select("source", "source_id", "event_id")
    return store.new_rows(e, e.filter("event_id < 500"), ["event_id"]).select("source", "event_id")


@query("SELECT count(*) AS inserted FROM events e WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.event_type = e.event_type AND x.event_id = e.event_id)")
def ingest_replay_zero(spark, sf_dir):
    e = _events(spark, sf_dir).select("source", "source_id", "event_id")
    return store.new_rows(e, e, ["event_id"]).agg(F.count("*").alias("inserted"))


@query("""SELECT count(*) AS violations FROM events b WHERE event_id % 2 = 0 AND NOT EXISTS (SELECT 1 FROM events a WHERE a.event_type = b.event_type AND a.event_id = b.event_id AND a.user_id IS NOT DISTINCT FROM b.user_id AND a.value IS NOT DISTINCT FROM b.value)""")
def append_only_invariant(spark, sf_dir):
    e = _events(spark, sf_dir).select("source", "source_id", "user_id", "value")
    return store.violations(e.filter("CAST(source_id AS BIGINT) % 2 = 0"), e).agg(F.count("*").alias("violations"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY 1")
def source_counts(spark, sf_dir):
    return _t(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")).orderBy("source")


@query("SELECT count(*) AS n FROM pages WHERE url LIKE 'http://th%'")
def prefix_count_like(spark, sf_dir):
    return _t(spark, sf_dir, "pages").filter(F.col("url").startswith("http://th")).agg(F.count("*").alias("n"))


@query("SELECT user_id, event_id AS cursor FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def cursor_upsert_latest(spark, sf_dir):
    e = _events(spark, sf_dir).select("user_id", "event_id", F.struct("ts", "event_id").alias("version"))
    half = F.col("event_id") % 2 == 0
    return store.upserted(e.filter(half), e.filter(~half), ["user_id"], "version").select("user_id", F.col("event_id").alias("cursor"))


@query("SELECT user_id AS run_id, event_type AS source, event_id AS last_event FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def brief_superseded_latest(spark, sf_dir):
    latest = insight.latest(_events(spark, sf_dir), ["user_id", "source"], ["ts", "event_id"])
    return latest.select(F.col("user_id").alias("run_id"), "source", F.col("event_id").alias("last_event"))


_LEDGER = "CASE o_orderkey % 3 WHEN 0 THEN 'start' WHEN 1 THEN 'usage' ELSE 'finish' END"


@query(f"""SELECT CAST(o_custkey AS VARCHAR) AS run_id, coalesce(max(o_orderstatus) FILTER (WHERE k = 'finish' AND rn = 1), 'running') AS status, CAST(sum(CASE WHEN k = 'usage' THEN o_orderkey END) AS BIGINT) AS input_tokens,
  CAST(sum(CASE WHEN k = 'usage' THEN round(CAST(o_totalprice AS DECIMAL(20,6)) * 0.000001, 4) END) AS DECIMAL(20,4)) AS cost_usd, bool_or(k = 'start') AS has_start
  FROM (SELECT *, {_LEDGER} AS k, row_number() OVER (PARTITION BY o_custkey, {_LEDGER} ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) GROUP BY o_custkey""")
def run_ledger(spark, sf_dir):
    o, usage = _t(spark, sf_dir, "orders"), F.col("o_orderkey") % 3 == 1
    kind = F.when(F.col("o_orderkey") % 3 == 0, "start").when(usage, "usage").otherwise("finish")
    price = F.col("o_totalprice").cast("decimal(20,6)") * F.lit("0.000001").cast("decimal(7,6)")
    events = o.select(F.col("o_custkey").cast("string").alias("run_id"), kind.alias("kind"), F.struct("o_orderdate", "o_orderkey").alias("at"), F.lit("ingest").alias("stage"), F.col("o_orderstatus").alias("status"),
                      F.when(usage, F.col("o_orderkey")).alias("input_tokens"), F.when(usage, F.col("o_orderkey")).alias("output_tokens"), F.when(usage, price).alias("cost_usd"))
    return store.ledger(events).select("run_id", "status", F.col("input_tokens").cast("long").alias("input_tokens"), F.col("cost_usd").cast("decimal(20,4)").alias("cost_usd"), "has_start")


@query(f"""SELECT count(*) AS orphans FROM (SELECT o_custkey, {_LEDGER} AS k FROM orders) e WHERE k <> 'start' AND NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_custkey = e.o_custkey AND s.o_orderkey % 3 = 0)""")
def run_ledger_orphans(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderkey") % 3 == 0, "start").when(F.col("o_orderkey") % 3 == 1, "usage").otherwise("finish")
    return store.orphan_events(o.select(F.col("o_custkey").alias("run_id"), kind.alias("kind"))).agg(F.count("*").alias("orphans"))


# --- incremental reads ---------------------------------------------------------------------------------------------

_FROM, _TO = 1705276800, 1705881600  # two whole minutes in January 2024


@query(f"SELECT event_type AS source, count(*) AS n FROM events WHERE {_MINUTE} >= {_FROM} AND {_MINUTE} <= {_TO} GROUP BY 1")
def window_first_inclusive(spark, sf_dir):
    bounds = windows.window("backfill", since=_FROM, until=_TO)
    return _events(spark, sf_dir).filter(windows.in_window(_minute(), bounds)).groupBy("source").agg(F.count("*").alias("n"))


@query(f"SELECT event_type AS source, count(*) AS n FROM events WHERE {_MINUTE} > {_FROM} AND {_MINUTE} <= {_TO} GROUP BY 1")
def window_resume_exclusive(spark, sf_dir):
    bounds = windows.window("backfill", cursor=_FROM, since=0, until=_TO)
    return _events(spark, sf_dir).filter(windows.in_window(_minute(), bounds)).groupBy("source").agg(F.count("*").alias("n"))


_CAPPED = f"""SELECT * FROM (SELECT event_type AS source, event_id, {_MINUTE} AS m, (row_number() OVER (PARTITION BY event_type ORDER BY {_MINUTE} DESC, event_id) - 1) // 100 AS page,
  CAST(ceil(count(*) OVER (PARTITION BY event_type) / 100.0) AS BIGINT) AS pages FROM events) WHERE page >= pages - 3"""


def _capped(spark, sf_dir):
    hits = _events(spark, sf_dir).select("source", "event_id", _minute().alias("m"))
    return windows.oldest_pages(windows.paged(hits, "source", "m", "event_id", 100), 3)


@query(f"SELECT source, event_id, page, pages > 3 AS capped FROM ({_CAPPED})")
def capped_pages_oldest_first(spark, sf_dir):
    return _capped(spark, sf_dir).select("source", "event_id", "page", "capped")


@query(f"""WITH r AS ({_CAPPED}), d AS (SELECT DISTINCT source, m, pages > 3 AS capped FROM r), k AS (SELECT *, dense_rank() OVER (PARTITION BY source ORDER BY m DESC) AS rk FROM d)
  SELECT source, CASE WHEN max(capped) THEN coalesce(max(CASE WHEN rk = 2 AND m > 1704067200 THEN m END), 1704067200) ELSE {_TO} END AS boundary,
  max(capped) AND coalesce(max(CASE WHEN rk = 2 AND m > 1704067200 THEN m END), 1704067200) <= 1704067200 AS stalled FROM k GROUP BY 1""")
def tie_safe_boundary(spark, sf_dir):
    return windows.boundaries(_capped(spark, sf_dir), "source", "m", F.lit(1704067200).cast("long"), F.lit(_TO).cast("long")).select("source", "boundary", "stalled")


@query(f"""SELECT event_type AS source, least(CAST({_TO} AS BIGINT), min({_SECONDS}) FILTER (WHERE event_id % 97 = 0) - 1) AS boundary,
  count(*) FILTER (WHERE event_id % 17 = 0) * 2 >= count(*) FILTER (WHERE event_id % 97 <> 0) AND count(*) FILTER (WHERE event_id % 17 = 0) > 0 AS truncated FROM events GROUP BY 1""")
def transient_boundary(spark, sf_dir):
    e, i = _events(spark, sf_dir), F.col("event_id")
    out = e.select("source", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"), F.when(i % 97 == 0, "transient-failure").when(i % 17 == 0, "malformed").otherwise("document").alias("outcome"))
    bounds = e.select("source").distinct().select("source", F.lit(_TO).cast("long").alias("boundary"), F.lit(False).alias("stalled"))
    return windows.confirmed(out, bounds, "s", F.lit(0), ["source"]).select("source", "boundary", "truncated")


@query("""SELECT event_id, CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS query_idx FROM events""")
def query_union_dedup(spark, sf_dir):
    e = _events(spark, sf_dir).select("event_id", "user_id", "source")
    hits = e.filter("source = 'click'").withColumn("query_idx", F.lit(0)).unionByName(e.filter("user_id < 50 OR source <> 'click'").withColumn("query_idx", F.lit(1)))
    return windows.unique_hits(hits, "event_id", ["query_idx"]).select("event_id", "query_idx")


@query("""SELECT event_type AS source, event_id FROM (SELECT *, max(CASE WHEN user_id < 3 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY ts DESC, event_id ROWS UNBOUNDED PRECEDING) AS stopped FROM events) WHERE stopped = 0""")
def prefix_until_mark(spark, sf_dir):
    e = _events(spark, sf_dir).withColumn("neg", -F.unix_micros(F.col("ts").cast("timestamp")))
    return windows.until_mark(e, ["source"], ["neg", "event_id"], "user_id", F.lit(2)).select("source", "event_id")


@query(f"""SELECT event_type AS source, event_id FROM events WHERE {_SECONDS} BETWEEN {_FROM} AND {_TO} AND {_SECONDS} > {_FROM} + 3600""")
def backfill_in_range(spark, sf_dir):
    e = _events(spark, sf_dir).withColumn("s", F.unix_seconds(F.col("ts").cast("timestamp"))).withColumn("neg", -F.col("s"))
    return windows.backfilled(e, ["source"], ["neg", "event_id"], "s", F.lit(_FROM), F.lit(_TO), F.lit(_FROM + 3600)).select("source", "event_id")


@query("""WITH w AS (SELECT *, coalesce(max(CASE WHEN user_id < 3 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY ts DESC, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped FROM events)
  SELECT event_type AS source, max(user_id) AS mark FROM w WHERE stopped = 0 GROUP BY 1""")
def newest_seen_mark(spark, sf_dir):
    e = _events(spark, sf_dir).withColumn("neg", -F.unix_micros(F.col("ts").cast("timestamp")))
    return windows.newest_seen(e, ["source"], ["neg", "event_id"], "user_id", F.lit(2))


@query(f"SELECT event_id // 100 AS page, bool_or({_SECONDS} < {_FROM}) AS passed FROM events GROUP BY 1")
def passed_window_flag(spark, sf_dir):
    e = _events(spark, sf_dir).select(F.floor(F.col("event_id") / 100).cast("long").alias("page"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"))
    return windows.passed_window(e, "page", "s", F.lit(_FROM))


@query("""SELECT e.i * n.n + r.r AS ordinal, e.event_type || ':' || r.r_name AS pair, e.event_type || ' (' || r.r_name || ')' AS label
  FROM (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS i FROM (SELECT DISTINCT event_type FROM events)) e,
  (SELECT r_name, row_number() OVER (ORDER BY r_name) - 1 AS r FROM region) r, (SELECT count(*) AS n FROM region) n""")
def pair_cross_product(spark, sf_dir):
    kinds = _events(spark, sf_dir).select("source").distinct()
    both = windows.pairs(kinds, _t(spark, sf_dir, "region").select("r_name"))
    return both.select("ordinal", C.pair_key(F.col("source"), F.col("r_name")).alias("pair"), C.pair_label(F.col("source"), F.col("r_name")).alias("label"))


# --- runs ----------------------------------------------------------------------------------------------------------

_LOG = """SELECT user_id AS run, event_type AS source, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS page, CAST(event_id // 2 AS VARCHAR) AS given,
  CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN CAST(event_id // 2 AS VARCHAR) ELSE CAST(event_id AS VARCHAR) || 'n' END AS next, CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 40 END AS offered, event_id % 10 = 0 AS partial FROM events"""
_WHY = "CASE WHEN next = given AND partial THEN 'stalled' WHEN next IS NULL THEN 'exhausted' WHEN next = given AND offered > 0 THEN 'no-progress-with-documents' WHEN next = given THEN 'no-progress' END"
_STOPS = f"""SELECT run, source, count(*) AS pages, CAST(sum(offered) AS BIGINT) AS fetched, coalesce(max(why), 'page-limit') AS stop_reason,
  CASE WHEN max(why) = 'stalled' THEN 'stalled' WHEN bool_or(partial) THEN 'partial' ELSE 'complete' END AS status
  FROM (SELECT *, min(CASE WHEN why IS NOT NULL THEN page END) OVER (PARTITION BY run, source) AS e FROM (SELECT *, {_WHY} AS why FROM ({_LOG}) WHERE page <= 25)) WHERE e IS NULL OR page <= e GROUP BY 1, 2"""


def _page_log(spark, sf_dir):
    """A page log made from events: a source's n-th event of a user is its n-th page."""
    i, e = F.col("event_id"), _events(spark, sf_dir)
    given = F.floor(i / 2).cast("string")
    page = F.row_number().over(Window.partitionBy("user_id", "source").orderBy("ts", "event_id"))
    return e.select(F.col("user_id").alias("run"), "source", page.alias("page"), given.alias("given"), F.when(i % 7 == 0, None).when(i % 5 == 0, given).otherwise(F.concat(i.cast("string"), F.lit("n"))).alias("next"),
                    F.when(i % 3 == 0, 0).otherwise(i % 40).alias("offered"), (i % 10 == 0).alias("partial"))


@query(_STOPS)
def page_loop_stop_reason(spark, sf_dir):
    return runs.stop_reasons(_page_log(spark, sf_dir)).withColumn("fetched", F.col("fetched").cast("long"))


@query(f"""SELECT run, CASE WHEN count(*) FILTER (WHERE status IN ('complete','partial')) = 0 THEN 'FAILED' WHEN count(*) FILTER (WHERE status = 'complete') = count(*) THEN 'COMPLETE' ELSE 'PARTIAL' END AS run_status FROM ({_STOPS}) GROUP BY 1""")
def run_status_rollup(spark, sf_dir):
    return runs.run_status(runs.stop_reasons(_page_log(spark, sf_dir)))


@query(f"""SELECT run_status, CASE WHEN run_status = 'FAILED' THEN 'retry' ELSE 'done' END AS action, count(*) AS n FROM (SELECT run, CASE WHEN count(*) FILTER (WHERE status IN ('complete','partial')) = 0 THEN 'FAILED'
  WHEN count(*) FILTER (WHERE status = 'complete') = count(*) THEN 'COMPLETE' ELSE 'PARTIAL' END AS run_status FROM ({_STOPS}) GROUP BY 1) GROUP BY ALL""")
def job_retry_decision(spark, sf_dir):
    done = runs.run_status(runs.stop_reasons(_page_log(spark, sf_dir)))
    return done.select("run_status", runs.retry_decision(F.col("run_status")).alias("action")).groupBy("run_status", "action").agg(F.count("*").alias("n"))


@query("""SELECT CAST(s.o AS BIGINT) AS ordinal, s.source, CASE WHEN s.source = 'hackernews' THEN 'complete' WHEN s.source = 'reddit' THEN 'skipped' ELSE 'not-attempted' END AS status,
  CASE WHEN s.source = 'hackernews' THEN (SELECT count(*) FROM events) ELSE 0 END AS fetched, CASE WHEN s.source = 'reddit' THEN 'credentials are not configured' END AS reason
  FROM (VALUES (0, 'hackernews'), (1, 'appstore'), (2, 'reddit')) s(o, source)""")
def skipped_sources_left_join(spark, sf_dir):
    n = _events(spark, sf_dir).agg(F.count("*").alias("fetched"))
    counts = n.select(F.lit("hackernews").alias("source"), F.lit("complete").alias("status"), "fetched", F.col("fetched").alias("inserted"), F.lit(0).alias("duplicates"))
    skipped = spark.createDataFrame([("reddit", "credentials are not configured")], "source string, reason string")
    return runs.every_source(counts, skipped, spark).select("ordinal", "source", "status", "fetched", "reason")


@query(f"SELECT CAST(sum(fetched) AS BIGINT) AS fetched, CAST(sum(pages) AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS duplicates FROM ({_STOPS})")
def run_totals(spark, sf_dir):
    s = runs.stop_reasons(_page_log(spark, sf_dir))
    return runs.totals(s.select("fetched", F.col("pages").alias("inserted"), F.lit(0).alias("duplicates")))


# --- trees ---------------------------------------------------------------------------------------------------------

@query("""WITH RECURSIVE n AS (SELECT conv_id, turn, CASE WHEN turn = 0 THEN NULL ELSE (turn - 1) // 2 END AS parent, turn % 5 <> 4 AS mapped FROM conversations),
  b AS (SELECT *, coalesce(sum(CASE WHEN mapped THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, parent ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken FROM n), k AS (SELECT * FROM b WHERE taken < 1),
  w AS (SELECT conv_id, turn, mapped, 1 AS depth, CAST(turn AS VARCHAR) AS path FROM k WHERE parent IS NULL UNION ALL
  SELECT k.conv_id, k.turn, k.mapped, w.depth + 1, w.path || '.' || k.turn FROM w JOIN k ON k.conv_id = w.conv_id AND k.parent = w.turn WHERE w.mapped AND w.depth < 3)
  SELECT conv_id, turn, mapped, depth, path FROM w""")
def comment_tree_walk(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations")
    nodes = c.select("conv_id", "turn", F.when(F.col("turn") > 0, F.floor((F.col("turn") - 1) / 2).cast("long")).alias("parent"), (F.col("turn") % 5 != 4).alias("mapped"))
    walked = tree.walk_edges(nodes, "conv_id", "turn", "parent", "turn", 3, 1, "mapped")
    return walked.select("conv_id", "turn", "mapped", "depth", F.array_join("path", ".").alias("path"))


@query("SELECT conv_id, count(*) AS num_comments FROM conversations GROUP BY 1 HAVING count(*) >= 5")
def thread_qualifies(spark, sf_dir):
    return tree.qualifying(_t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("num_comments")))


@query("""SELECT source, count(*) FILTER (WHERE n_chars % 2 = 0) AS skipped, count(*) AS candidates, count(*) FILTER (WHERE n_chars % 2 = 0) * 2 >= count(*) AS truncated FROM documents GROUP BY 1""")
def shortfall_ratio(spark, sf_dir):
    n = _t(spark, sf_dir, "documents").groupBy("source").agg(F.count_if(F.col("n_chars") % 2 == 0).alias("skipped"), F.count("*").alias("candidates"))
    return n.withColumn("truncated", normalize.shortfall(F.col("skipped"), F.col("candidates")))


@query("""WITH e AS (SELECT conv_id AS page, turn AS pos, CASE WHEN turn % 4 = 3 THEN 'RATE_LIMIT' WHEN turn % 4 = 1 THEN 'UPSTREAM' END AS c FROM conversations)
  SELECT page, CASE WHEN min(CASE WHEN c = 'RATE_LIMIT' THEN pos END) IS NOT NULL THEN 'RATE_LIMIT' ELSE min(c) END AS error_code, coalesce(min(CASE WHEN c = 'RATE_LIMIT' THEN pos END), max(pos)) AS last_pos FROM e GROUP BY 1""")
def expansion_first_error(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations")
    return tree.expansion_error(c.select(F.col("conv_id").alias("page"), F.col("turn").alias("pos"), F.when(F.col("turn") % 4 == 3, "RATE_LIMIT").when(F.col("turn") % 4 == 1, "UPSTREAM").alias("error_code")))


# --- cost ----------------------------------------------------------------------------------------------------------

_COST = "(CAST(o_orderkey * 1000 AS DECIMAL(20,2)) + CAST(o_custkey AS DECIMAL(18,0)) * 1.25 + CAST(o_custkey % 7 AS DECIMAL(18,0)) * 0.1) * CAST(0.5 AS DECIMAL(8,4)) * 0.000001 + CAST(o_custkey AS DECIMAL(18,0)) * CAST(2.5 AS DECIMAL(8,4)) * 0.000001"


def _calls(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    usage = o.select("o_orderkey", "o_orderdate", F.col("o_custkey").alias("run_id"), (F.col("o_orderkey") * 1000).alias("input_tokens"), F.col("o_custkey").alias("output_tokens"),
                     F.col("o_custkey").alias("cache_write"), (F.col("o_custkey") % 7).alias("cache_read"))
    return cost.priced(usage, "batch")


@query(f"SELECT o_orderkey, CAST(o_orderkey * 1000 + o_custkey + o_custkey % 7 AS BIGINT) AS input_total, CAST({_COST} AS DECIMAL(38,12)) AS cost FROM orders")
def usage_cost(spark, sf_dir):
    return _calls(spark, sf_dir).select("o_orderkey", C.total_input_tokens(F.col("input_tokens"), F.col("cache_write"), F.col("cache_read")).alias("input_total"), "cost")


@query(f"SELECT o_custkey AS run_id, CAST(sum(o_orderkey * 1000) AS BIGINT) AS input_tokens, CAST(sum(o_custkey) AS BIGINT) AS output_tokens, CAST(sum(round(CAST({_COST} AS DECIMAL(38,12)), 4)) AS DECIMAL(20,4)) AS cost_usd FROM orders GROUP BY 1")
def usage_accumulate(spark, sf_dir):
    return cost.recorded(_calls(spark, sf_dir)).withColumn("cost_usd", F.col("cost_usd").cast("decimal(20,4)"))


@query("SELECT CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(20,2))), 0) AS DECIMAL(20,4)) AS spend FROM orders WHERE o_orderdate > TIMESTAMP '1996-06-01 00:00:00' - INTERVAL 720 HOURS")
def trailing_spend_30d(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderdate", F.col("o_totalprice").cast("decimal(20,2)").alias("cost_usd"))
    return cost.trailing_spend(o, F.expr("TIMESTAMP_NTZ '1996-06-01 00:00:00'"), at="o_orderdate")


@query("""SELECT o_custkey, CASE WHEN s + 1000.00 > 1000000.00 THEN 'exceeded' WHEN s + 1000.00 >= 1000000.00 * 0.80 THEN 'warning' ELSE 'ok' END AS verdict FROM (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(20,2))) AS s FROM orders GROUP BY 1)""")
def budget_guard(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(20,2)")).alias("s"))
    dollars = lambda x: F.lit(x).cast("decimal(20,2)")
    return o.select("o_custkey", cost.budget(F.col("s"), dollars("1000.00"), dollars("1000000.00")).alias("verdict"))


@query("""SELECT o_orderkey AS ordinal, CASE WHEN o_orderkey % 4 = 0 THEN 'expired' WHEN o_orderkey % 4 = 1 THEN 'errored' ELSE 'succeeded' END AS type, CASE WHEN o_orderkey % 4 = 0 THEN 'missing_result' END AS error,
  CAST(CASE WHEN o_orderkey % 4 >= 2 THEN o_custkey + 1 ELSE 0 END AS BIGINT) AS input_tokens FROM orders""")
def batch_result_join(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    asked = o.select(F.col("o_orderkey").alias("ordinal"), F.col("o_orderkey").cast("string").alias("custom_id"))
    kind = F.when(F.col("o_orderkey") % 4 == 1, "errored").otherwise("succeeded")
    came = o.filter("o_orderkey % 4 > 0").select(F.col("o_orderkey").cast("string").alias("custom_id"), kind.alias("type"), F.col("o_custkey").alias("output_tokens"), "o_custkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("arrival"))
    answers = came.withColumn("input_tokens", F.col("o_custkey") + F.col("arrival")).drop("o_custkey")
    return cost.results(asked, answers).select("ordinal", "type", "error", "input_tokens")


@query("SELECT CAST((sum(o_custkey) * 0.5 + count(*) * 100 * 2.5) * 0.000001 AS DECIMAL(38,12)) AS pending FROM orders")
def pending_estimate(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("estimated_tokens"), F.lit(100).alias("max_tokens"))
    return cost.pending_cost(o, "batch")


@query("""WITH d AS (SELECT date_trunc('day', o_orderdate) AS day, o_orderpriority AS stage, count(*) AS runs, sum(CAST(o_totalprice AS DECIMAL(20,2))) AS cost FROM orders GROUP BY ALL),
  r AS (SELECT day, sum(c) OVER (ORDER BY day RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS spend FROM (SELECT day, sum(cost) AS c FROM d GROUP BY 1))
  SELECT CAST(day AS DATE) AS day, stage, runs, CAST(cost AS DECIMAL(30,2)) AS cost, CAST(spend AS DECIMAL(30,2)) AS spend_30d FROM d JOIN r USING (day)""")
def run_history_30d(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderdate", F.col("o_orderpriority").alias("stage"), F.col("o_totalprice").cast("decimal(20,2)").alias("cost_usd"))
    h = cost.history(o, "o_orderdate")
    return h.select(F.col("day").cast("date").alias("day"), "stage", "runs", F.col("cost").cast("decimal(30,2)").alias("cost"), F.col("spend_30d").cast("decimal(30,2)").alias("spend_30d"))


# --- request policy ------------------------------------------------------------------------------------------------

@query("SELECT CAST(range AS BIGINT) AS attempt, CAST(least(250 * power(2, range - 1), 30000) AS BIGINT) AS delay_ms, CAST(least(60 * power(2, range - 1), 900) AS BIGINT) AS job_s FROM range(1, 11)")
def retry_backoff_schedule(spark, sf_dir):
    return spark.range(1, 11).select(F.col("id").alias("attempt"), C.backoff_ms(F.col("id")).alias("delay_ms"), policy.job_backoff_s(F.col("id")).alias("job_s"))


@query("SELECT CAST(range AS BIGINT) AS status, range = 429 OR range BETWEEN 500 AND 599 AS retryable FROM range(100, 700)")
def retryable_status(spark, sf_dir):
    return spark.range(100, 700).select(F.col("id").alias("status"), C.retryable(F.col("id")).alias("retryable"))


@query("""SELECT event_id, CASE WHEN NOT (s = 429 OR s BETWEEN 500 AND 599) THEN 'return' WHEN a < 5 THEN 'retry' WHEN s = 429 THEN 'rate-limited' ELSE 'upstream-error' END AS action,
  CASE WHEN (s = 429 OR s BETWEEN 500 AND 599) AND a < 5 THEN CAST(CASE WHEN event_id % 3 = 0 THEN least((event_id % 60) * 1000, 30000) ELSE least(250 * power(2, a - 1), 30000) END AS BIGINT) END AS delay_ms
  FROM (SELECT event_id, event_id % 5 + 1 AS a, CASE event_id % 4 WHEN 0 THEN 200 WHEN 1 THEN 429 WHEN 2 THEN 503 ELSE 404 END AS s FROM events)""")
def retry_attempts(spark, sf_dir):
    i = F.col("event_id")
    r = _events(spark, sf_dir).select("event_id", (i % 5 + 1).alias("attempt"), F.when(i % 4 == 0, 200).when(i % 4 == 1, 429).when(i % 4 == 2, 503).otherwise(404).alias("status"),
                                      F.when(i % 3 == 0, (i % 60).cast("string")).otherwise("soon").alias("retry_after"), F.lit(0).cast("long").alias("at_ms"))
    return policy.attempts(r).select("event_id", "action", "delay_ms")


@query("""WITH q AS (SELECT host, event_id, t, row_number() OVER (PARTITION BY host ORDER BY t, event_id) AS n, min(t) OVER (PARTITION BY host) AS t0 FROM (SELECT user_id AS host, event_id, 1000 * SECONDS AS t FROM events)),
  x AS (SELECT *, (t - t0) * (5.0::DOUBLE / 86400000) - (n - 1) AS f FROM q), y AS (SELECT *, 5.0::DOUBLE + f - greatest(0, max(f) OVER (PARTITION BY host ORDER BY n)) - 1 AS l FROM x)
  SELECT host, event_id, round(CASE WHEN l < 0 THEN -l / (5.0::DOUBLE / 86400000) ELSE 0 END, 2) AS delay_ms FROM y""".replace("SECONDS", _SECONDS))
def token_bucket_delays(spark, sf_dir):
    e = _events(spark, sf_dir).select(F.col("user_id").alias("host"), F.col("event_id").alias("id"), (1000 * F.unix_seconds(F.col("ts").cast("timestamp"))).alias("at_ms"))
    return policy.bucket_delays(e, 5, 86_400_000).select("host", F.col("id").alias("event_id"), F.round("delay_ms", 2).alias("delay_ms"))


# --- analytics (own formulas) --------------------------------------------------------------------------------------

@query("""SELECT query, id, rank FROM (SELECT a.vec_id AS query, b.vec_id AS id, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) DESC, b.vec_id) AS rank
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0) WHERE rank <= 5""")
def embedding_topk_cosine(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    return insight.top_similar(e.filter("id % 20 = 0"), e, 5, "label").select("query", "id", "rank")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings WHERE label < 5)")
def embedding_missing_anti(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    e = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("document_id"), F.when(F.col("label") < 5, "m").otherwise("other").alias("model"))
    return store.missing_embeddings(d, e, "m").select(F.col("id").alias("doc_id"))


@query("""SELECT t.t AS threshold, round(count(*) FILTER (WHERE s >= t.t AND quality = 1) / CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE), 6) AS recall, round(count(*) FILTER (WHERE s < t.t AND quality <> 1) / CAST(count(*) FILTER (WHERE quality <> 1) AS DOUBLE), 6) AS noise_rejection
  FROM (SELECT quality, least(n_chars, 5000) / 5000.0::DOUBLE AS s FROM labels JOIN documents USING (doc_id)), (VALUES (0.1::DOUBLE), (0.25), (0.5), (0.75)) t(t) GROUP BY 1""")
def prefilter_threshold_sweep(spark, sf_dir):
    d = _t(spark, sf_dir, "labels").join(_t(spark, sf_dir, "documents"), "doc_id")
    return insight.sweep(d.select(F.col("quality").alias("label"), (F.least("n_chars", F.lit(5000)) / 5000.0).alias("score")), [0.1, 0.25, 0.5, 0.75])


@query(r"""WITH d AS (SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
  n AS (SELECT count(*) AS total, avg(len(w)) AS mean FROM d), s AS (SELECT DISTINCT item_id AS seed, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) AS term FROM benchmark),
  p AS (SELECT id, term, count(*) AS tf, max(l) AS l FROM (SELECT id, len(w) AS l, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM s) GROUP BY 1, 2), r AS (SELECT term, ln(1 + (total - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM p, n GROUP BY term, total),
  b AS (SELECT id, max(score) AS score FROM (SELECT id, seed, sum(idf * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * l / mean))) AS score FROM p JOIN r USING (term) JOIN s USING (term), n GROUP BY 1, 2) GROUP BY 1)
  SELECT id, round(coalesce(score, 0), 4) AS score FROM d LEFT JOIN b USING (id)""")
def lexical_prefilter(spark, sf_dir):
    """BM25 of every document against the benchmark's passages as seeds."""
    d = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("body"))
    seeds = _t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("body"))
    return insight.lexical_scores(d, seeds).select("id", F.round("score", 4).alias("score"))


@query("""SELECT doc_id, CASE WHEN n_chars >= 3000 OR regexp_matches(lower(text), 'token|license') THEN 'candidate' ELSE 'noise' END AS verdict FROM documents""")
def prefilter_candidates(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", insight.prefilter(F.col("n_chars"), F.col("text"), 3000, "token|license").alias("verdict"))


@query("""WITH RECURSIVE e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) >= 0.4),
  w AS (SELECT vec_id AS id, vec_id AS r FROM embeddings UNION SELECT w.id, e.b FROM w JOIN e ON e.a = w.r) SELECT id, min(r) AS cluster FROM w GROUP BY 1""")
def cluster_components(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    return insight.clusters(e, 0.4, "label", written)


#: Minimax similarities within a label, by squaring: the greatest least link of any path of so many steps.
_CLOSURE = "s0 AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, CASE WHEN a.vec_id = b.vec_id THEN 2 ELSE round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) END AS s FROM embeddings a JOIN embeddings b ON a.label = b.label)" + "".join(
    f", s{k + 1} AS MATERIALIZED (SELECT x.a, y.b, max(least(x.s, y.s)) AS s FROM s{k} x JOIN s{k} y ON x.b = y.a GROUP BY 1, 2)" for k in range(6))


@query(f"""WITH {_CLOSURE}, m AS (SELECT a, max(s) FILTER (WHERE b < a) AS m FROM s6 GROUP BY 1), n AS (SELECT count(*) AS n FROM embeddings),
  kept AS (SELECT min(m) AS least FROM (SELECT m, row_number() OVER (ORDER BY m DESC) AS place FROM m WHERE m IS NOT NULL) WHERE place <= (SELECT n - 100 FROM n))
  SELECT a AS id, min(b) AS cluster FROM s6, kept WHERE s >= least GROUP BY 1""")
def clusters_by_count(spark, sf_dir):
    """Exactly a hundred clusters: the spanning forest without its weakest links."""
    e = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    return insight.clusters(e, 1.0, "label", written, count=100)


@query("""WITH RECURSIVE e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) >= 0.6),
  w AS (SELECT vec_id AS id, vec_id AS r FROM embeddings UNION SELECT w.id, e.b FROM w JOIN e ON e.a = w.r) SELECT id, min(r) AS cluster FROM w GROUP BY 1""")
def similarity_join_banded(spark, sf_dir):
    """Groups of near vectors by bands of hyperplanes, without comparing all pairs of a label."""
    e = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    labels = insight.smallest_reachable(vectors.banded_edges(e, 0.6, "label"), written)
    return e.select("id").join(labels.hint("merge"), F.col("id") == F.col("node"), "left").select("id", F.coalesce("label", "id").alias("cluster"))


@query("""SELECT query, id, rank FROM (SELECT a.vec_id AS query, b.vec_id AS id, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) DESC, b.vec_id) AS rank
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0) WHERE rank <= 5""")
def vector_index_search(spark, sf_dir):
    """The five nearest of every twentieth vector from a stored index: the lists that can hold one, and no others."""
    e = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    index = vectors.Index.make(e, f"{folder(spark)}/index-{uuid.uuid4().hex}", lists=16, neighbours=5)
    return index.search(e.filter("id % 20 = 0"), 5, exact=True).select("query", "id", "rank")


@query("SELECT label AS cluster, count(DISTINCT source) AS sources, count(*) AS mentions FROM embeddings JOIN documents ON doc_id = vec_id GROUP BY 1")
def source_diversity(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings").join(_t(spark, sf_dir, "documents"), F.col("vec_id") == F.col("doc_id"))
    return insight.source_diversity(e.select(F.col("label").alias("cluster"), "source"))


@query("""SELECT cluster, CAST(CAST(frequency AS DECIMAL(10,6)) * 0.30 + CAST(0.5 AS DECIMAL(10,6)) * 0.25 + CAST(recency AS DECIMAL(10,6)) * 0.20 + CAST(diversity AS DECIMAL(10,6)) * 0.15 + CAST(1.0 AS DECIMAL(10,6)) * 0.10 AS DECIMAL(20,8)) AS composite
  FROM (SELECT source AS cluster, round(count(*) / 1000.0::DOUBLE, 6) AS frequency, round(power(0.5::DOUBLE, avg(n_chars) / 180.0), 6) AS recency, count(DISTINCT lang) / 4.0::DOUBLE AS diversity FROM documents GROUP BY 1)""")
def composite_score_decay(spark, sf_dir):
    t = _t(spark, sf_dir, "documents").groupBy(F.col("source").alias("cluster")).agg(
        F.round(F.count("*") / 1000.0, 6).alias("frequency"), F.round(insight.decay(F.avg("n_chars")), 6).alias("recency"), (F.count_distinct("lang") / 4.0).alias("source_diversity"))
    return insight.composite(t.withColumns({"intensity": F.lit(0.5), "solution_gap": F.lit(1.0)})).select("cluster", "composite")


@query("SELECT l_orderkey AS cluster, CASE WHEN count(*) FILTER (WHERE l_returnflag <> 'N') = 0 THEN 'none' WHEN count(*) FILTER (WHERE l_returnflag = 'R') * 2 >= count(*) FILTER (WHERE l_returnflag <> 'N') THEN 'criticized' ELSE 'approved' END AS gap FROM lineitem GROUP BY 1")
def solution_gap(spark, sf_dir):
    n = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("cluster")).agg(F.count_if(F.col("l_returnflag") != "N").alias("tools"), F.count_if(F.col("l_returnflag") == "R").alias("bad"))
    return n.select("cluster", insight.solution_gap(F.col("tools"), F.col("bad")).alias("gap"))


_RANKED = "SELECT source, quality, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM labels JOIN documents USING (doc_id)"


def _ranked(spark, sf_dir):
    d = _t(spark, sf_dir, "labels").join(_t(spark, sf_dir, "documents"), "doc_id")
    return d.select("source", "quality", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id")).alias("rank"))


@query(f'SELECT source, round(sum(CAST(quality AS DOUBLE)) / 10, 6) AS "precision" FROM ({_RANKED}) WHERE rank <= 10 GROUP BY 1')
def precision_at_10(spark, sf_dir):
    return insight.precision_at(_ranked(spark, sf_dir), 10, "source", relevant="quality")


@query(f"""SELECT source, round(CASE WHEN sum(quality / log2(i + 1)) > 0 THEN sum(quality / log2(rank + 1)) / sum(quality / log2(i + 1)) ELSE 0 END, 6) AS ndcg
  FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY quality DESC, rank) AS i FROM ({_RANKED})) GROUP BY 1""")
def ndcg(spark, sf_dir):
    return insight.ndcg(_ranked(spark, sf_dir), "source", gain="quality")


@query("SELECT doc_id % 100 AS brief, count(*) FILTER (WHERE doc_id % 7 = 0) = 0 AS intact, count(*) FILTER (WHERE doc_id % 7 = 0) AS missing FROM documents GROUP BY 1")
def citation_verbatim(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    span = F.when(F.col("doc_id") % 7 == 0, "no text has this span").otherwise(F.substring("text", 3, 40))
    return insight.citations(d.select((F.col("doc_id") % 100).alias("brief"), F.col("doc_id").alias("document_id"), span.alias("span")), d.select(F.col("doc_id").alias("id"), F.col("text").alias("body")))


@query("SELECT min(doc_id) AS first_doc, count(*) AS copies, count(DISTINCT source) AS sources FROM documents GROUP BY text HAVING count(*) > 1")
def exact_copy_cross_source(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("h"))
    n = d.groupBy("h").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), F.count_distinct("source").alias("sources"))
    return n.filter("copies > 1").drop("h")


@query("SELECT event_id, event_id % 6 IN (0, 1, 2) AS quarantined FROM events")
def quarantine_bad_json(spark, sf_dir):
    i = F.col("event_id")
    body = F.when(i % 6 == 0, "{broken").when(i % 6 == 1, "[1]").when(i % 6 == 2, '{"problem_statement": 5}').otherwise('{"problem_statement": "slow"}')
    return insight.quarantine(_events(spark, sf_dir).select("event_id", body.alias("body"))).select("event_id", "quarantined")


@query("SELECT o_custkey AS cluster, l_partkey AS document FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey")
def traceability_chain(spark, sf_dir):
    """The chain of every cluster."""
    members = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cluster"), F.col("o_orderkey").alias("point"))
    points = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("point")).agg(F.collect_list("l_partkey").alias("source_document_ids"))
    parts = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.lit("x").alias("source"))
    return insight.traced(members, points, parts).select("cluster", "document")


@query("SELECT o_custkey AS cluster, count(DISTINCT l_partkey) AS evidence FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def evidence_union(spark, sf_dir):
    points = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("source_document_ids"))
    members = _t(spark, sf_dir, "orders").join(points, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("cluster"), "source_document_ids")
    return insight.merged_evidence(members).select("cluster", F.size("source_document_ids").cast("long").alias("evidence"))


@query("SELECT * FROM (VALUES ('briefs'), ('cluster_members'), ('clusters'), ('embeddings'), ('pain_points'), ('scores')) t(name)")
def evidence_reachable_tables(spark, sf_dir):
    from evidora.schemas import reachable

    return reachable(spark)


# --- flagship ------------------------------------------------------------------------------------------------------

@query(f"""SELECT source, count(*) AS fetched, count(DISTINCT event_id) AS inserted, count(*) - count(DISTINCT event_id) AS duplicates, min({_SECONDS}) AS first_s, max({_SECONDS}) AS last_s FROM ({_PAGES}) GROUP BY 1""")
def ingest_summary(spark, sf_dir):
    """Two overlapping pages, first arrivals kept, counted by source."""
    return store.counts(_two_pages(spark, sf_dir).withColumn("s", F.unix_seconds(F.date_trunc("second", F.col("ts")).cast("timestamp"))), "s")
