"""Registered queries over whole reads of the three source shapes, on captures made from the test tables.

Events stand for search hits and their items, documents for the reviews of feeds (20 feeds of one territory), and
conversations for posts with their threads. Importing this module registers its queries with those of ``catalog``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidora.functions import columns as C
from evidora.operators import cost, insight, normalize, policy, runs, sketches, store, windows
from evidora.plans import ingest
from evidora.plans.catalog import _CLASS, _FROM, _SECONDS, _TO, QUERIES, SQL, _events, _item_rows, _page_log, _t, _two_pages, _LOG, _PAGES, _WHY, query
from evidora.shared import written

__all__ = ["QUERIES", "SQL"]

# --- search: capped pages over two queries, each hit looked up once --------------------------------------------------

_SIZE, _MOST = 20, 3


def _searched(spark, sf_dir):
    """An incremental read that resumes: the lower bound is exclusive, the upper one a minute before now."""
    e = _events(spark, sf_dir)
    hit = e.select("event_id", F.col("event_id").cast("string").alias("hit_id"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"), "source", "user_id")
    hits = hit.filter("source = 'click'").withColumn("query_idx", F.lit(0)).unionByName(hit.filter("user_id % 3 = 0 OR source <> 'click'").withColumn("query_idx", F.lit(1)))
    items = _item_rows(spark, sf_dir).filter("event_id % 29 > 0").select(F.col("event_id").cast("string").alias("hit_id"), "status", "body")
    bounds = windows.window("incremental", now=_TO + windows.LAG, cursor=_FROM)
    return ingest.search(hits.select("query_idx", "hit_id", "at"), items, bounds, _SIZE, _MOST)


_READ = f"""h AS (SELECT 0 AS q, event_id, {_SECONDS} AS s FROM events WHERE event_type = 'click' UNION ALL SELECT 1, event_id, {_SECONDS} FROM events WHERE user_id % 3 = 0 OR event_type <> 'click'),
  p AS (SELECT *, (row_number() OVER (PARTITION BY q ORDER BY s DESC, CAST(event_id AS VARCHAR)) - 1) // {_SIZE} AS page, CAST(ceil(count(*) OVER (PARTITION BY q) / {_SIZE}.0) AS BIGINT) AS pages FROM h WHERE s > {_FROM} AND s <= {_TO}),
  r AS (SELECT * FROM p WHERE page >= pages - {_MOST}), once AS (SELECT DISTINCT event_id, s FROM r),
  looked AS (SELECT once.*, user_id, CASE WHEN event_id % 29 = 0 THEN 'transient-failure' ELSE {_CLASS} END AS outcome FROM once JOIN events USING (event_id))"""


@query(f"""WITH {_READ} SELECT CAST(event_id AS VARCHAR) AS source_id, 'https://news.ycombinator.com/item?id=' || event_id AS url, CAST(user_id AS VARCHAR) AS author_handle, s AS created_s FROM looked WHERE outcome = 'document'""")
def search_documents(spark, sf_dir):
    documents, _ = _searched(spark, sf_dir)
    return documents.select("source_id", "url", "author_handle", F.unix_seconds("created_at").alias("created_s"))


@query(f"""WITH {_READ}, safe AS (SELECT q, max(pages) > {_MOST} AS capped, coalesce((SELECT max(s) FROM r b WHERE b.q = r.q AND b.s < max(r.s)), {_FROM}) AS second FROM r GROUP BY q),
  bound AS (SELECT least(min(CASE WHEN capped THEN greatest(second, {_FROM}) ELSE {_TO} END), {_TO}) AS b, coalesce(bool_or(capped AND second <= {_FROM}), false) AS stalled FROM safe),
  seen AS (SELECT min(s) FILTER (WHERE outcome = 'transient-failure') - 1 AS held, count(*) FILTER (WHERE outcome = 'malformed') AS bad, count(*) FILTER (WHERE outcome = 'document') AS good FROM looked)
  SELECT CAST(least(b, held) AS BIGINT) AS boundary, CAST(CASE WHEN least(b, held) > {_FROM} THEN least(b, held) END AS BIGINT) AS cursor,
  stalled OR (held IS NOT NULL AND least(b, held) <= {_FROM}) OR (bad > 0 AND bad * 2 >= bad + good) AS truncated FROM bound, seen""")
def search_report(spark, sf_dir):
    _, report = _searched(spark, sf_dir)
    return report.select("boundary", "cursor", "truncated")


# --- feeds: entries of pages, read until each pair's mark ------------------------------------------------------------

_NEWEST, _AGE, _BAD = "2024-01-31 00:00:00", 30, 17


def _fed(spark, sf_dir):
    """Pages of ten reviews, a feed for each of 20 apps. One feed has a page that failed, every fourth a mark."""
    d, i = _t(spark, sf_dir, "documents"), F.col("doc_id")
    label = lambda c: F.struct(c.alias("label"))
    place = F.floor(i / 20)
    at = F.timestamp_seconds(F.unix_seconds(F.lit(_NEWEST).cast("timestamp")) - 3600 * place)
    updated = F.concat(F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-00:00"))
    entry = F.struct(label(i.cast("string")).alias("id"), F.struct(label(F.col("source")).alias("name"), label(F.lit("x")).alias("uri")).alias("author"), label(updated).alias("updated"),
                     label(F.col("lang")).alias("content"), label(F.when(i % 3 == 0, "4.5").otherwise("2")).alias("im:rating"))
    rows = d.select((i % 20).cast("int").alias("ordinal"), (F.floor(place / 10) + 1).cast("int").alias("page"), i.alias("_i"), entry.alias("entry"))
    listed = rows.groupBy("ordinal", "page").agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "entry"))), lambda x: x["entry"]).alias("entry"))  # of one page
    failed = (F.col("ordinal") == _BAD) & (F.col("page") == 2)
    pages = listed.select("ordinal", F.col("ordinal").cast("string").alias("app_id"), F.lit("us").alias("territory"), "page", F.when(failed, 503).otherwise(200).alias("status"),
                          F.to_json(F.struct(F.struct("entry").alias("feed"))).alias("body"))
    mark = C.iso_ms(F.timestamp_seconds(F.unix_seconds(F.lit(_NEWEST).cast("timestamp")) - 3600 * _AGE))
    marks = spark.range(0, 20, 4).select(F.concat(F.col("id").cast("string"), F.lit(":us")).alias("pair"), mark.alias("mark"))
    return ingest.feed(pages, marks)


_FEEDS = f"""f AS (SELECT *, doc_id % 20 AS o, doc_id // 20 AS place, strftime(TIMESTAMP '{_NEWEST}' - INTERVAL (doc_id // 20) HOUR, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso FROM documents),
  gone AS (SELECT min(o) AS o FROM f WHERE o = {_BAD} AND place // 10 = 1), tried AS (SELECT f.* FROM f, gone WHERE gone.o IS NULL OR f.o <= gone.o),
  good AS (SELECT tried.*, CASE WHEN tried.o % 4 = 0 THEN strftime(TIMESTAMP '{_NEWEST}' - INTERVAL {_AGE} HOUR, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END AS mark FROM tried, gone WHERE (gone.o IS NULL OR tried.o < gone.o) AND doc_id % 3 <> 0),
  w AS (SELECT *, coalesce(max(CASE WHEN iso <= mark THEN 1 ELSE 0 END) OVER (PARTITION BY o ORDER BY place ROWS UNBOUNDED PRECEDING), 0) AS stopped,
    coalesce(max(CASE WHEN iso <= mark THEN 1 ELSE 0 END) OVER (PARTITION BY o ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS past FROM good)"""


@query(f"""WITH {_FEEDS} SELECT CAST(doc_id AS VARCHAR) AS source_id, 'https://apps.apple.com/us/app/id' || o || '?see-all=reviews' AS url, source AS author_handle, iso AS created_at FROM w WHERE stopped = 0""")
def feed_documents(spark, sf_dir):
    documents, _ = _fed(spark, sf_dir)
    return documents.select("source_id", "url", "author_handle", C.iso_ms(F.col("created_at")).alias("created_at"))


@query(f"""WITH {_FEEDS}, newest AS (SELECT o, max(iso) AS m FROM w WHERE past = 0 GROUP BY 1), pairs AS (SELECT DISTINCT o FROM tried)
  SELECT p.o || ':us' AS pair, coalesce(m, CASE WHEN p.o % 4 = 0 THEN strftime(TIMESTAMP '{_NEWEST}' - INTERVAL {_AGE} HOUR, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END) AS mark, coalesce(p.o = gone.o, false) AS failed
  FROM pairs p LEFT JOIN newest USING (o), gone""")
def feed_marks(spark, sf_dir):
    _, marks = _fed(spark, sf_dir)
    return marks.select("pair", "mark", "failed")


# --- listings: posts, and the comments of those that qualify ---------------------------------------------------------

def _listed(spark, sf_dir):
    """A page of ten posts, a post for each conversation, a thread for each post: turns on top, a reply to every second."""
    c = _t(spark, sf_dir, "conversations")
    post_id = F.concat(F.lit("p"), F.col("conv_id").cast("string"))
    posts = c.groupBy("conv_id").agg(F.count("*").alias("n"))
    data = F.struct(post_id.alias("id"), F.concat(F.lit("t3_"), post_id).alias("name"), F.concat(F.lit("/r/x/"), post_id, F.lit("/")).alias("permalink"), F.when(F.col("conv_id") % 7 > 0, "title").alias("title"),
                    (F.col("conv_id") + 1700000000).alias("created_utc"), F.col("n").alias("num_comments"))
    child = posts.select(F.floor(F.col("conv_id") / 10).cast("long").alias("page"), "conv_id", F.struct(F.lit("t3").alias("kind"), data.alias("data")).alias("child"))
    held = child.groupBy("page").agg(F.transform(F.sort_array(F.collect_list(F.struct("conv_id", "child"))), lambda x: x["child"]).alias("children"))  # of one page
    pages = held.select("page", F.to_json(F.struct(F.lit("Listing").alias("kind"), F.struct(F.concat(F.lit("a"), F.col("page").cast("string")).alias("after"), "children").alias("data"))).alias("body"))

    def comment(letter, *more):
        own = F.concat(F.lit(letter), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"))
        return F.struct(F.lit("t1").alias("kind"), F.struct(own.alias("id"), F.concat(F.lit("t1_"), own).alias("name"), F.when((F.lit(letter) == "r") | (F.col("turn") % 4 != 3), F.col("role")).alias("body"),
                                                           (F.col("turn") + 1).alias("created_utc"), *more).alias("data"))

    replies = F.when(F.col("turn") % 2 == 0, F.struct(F.struct(F.array(comment("r")).alias("children")).alias("data"))).alias("replies")
    top = c.select("conv_id", "turn", comment("c", replies).alias("comment"))
    grouped = top.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "comment"))), lambda x: x["comment"]).alias("children"))  # of one thread
    status = F.when(F.col("conv_id") % 11 == 0, 403).when(F.col("conv_id") % 13 == 0, 500).otherwise(200)
    threads = grouped.select(post_id.alias("thread"), status.alias("status"), F.concat(F.lit("[{},"), F.to_json(F.struct(F.struct("children").alias("data"))), F.lit("]")).alias("body"))
    return ingest.listing(pages, threads)


_LISTINGS = """posts AS (SELECT conv_id, count(*) AS n, conv_id // 10 AS page FROM conversations GROUP BY 1), wanted AS (SELECT * FROM posts WHERE conv_id % 7 > 0 AND n >= 5),
  top AS (SELECT w.conv_id, page, turn, turn % 4 <> 3 AS mapped, coalesce(sum(CASE WHEN turn % 4 <> 3 THEN 1 ELSE 0 END) OVER (PARTITION BY w.conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken
    FROM wanted w JOIN conversations USING (conv_id) WHERE w.conv_id % 11 > 0 AND w.conv_id % 13 > 0),
  near AS (SELECT * FROM top WHERE taken < 5), walked AS (SELECT conv_id, page, mapped, 'c' || conv_id || '_' || turn AS id FROM near UNION ALL SELECT conv_id, page, true, 'r' || conv_id || '_' || turn FROM near WHERE mapped AND turn % 2 = 0)"""


@query(f"""WITH {_LISTINGS} SELECT 't3_p' || conv_id AS source_id, 'https://www.reddit.com/r/x/p' || conv_id || '/' AS url, CAST(conv_id + 1700000000 AS BIGINT) AS created_s FROM posts WHERE conv_id % 7 > 0
  UNION ALL SELECT 't1_' || id, 'https://www.reddit.com/r/x/p' || conv_id || '/' || id || '/', CAST(split_part(id, '_', 2) AS BIGINT) + 1 FROM walked WHERE mapped""")
def listing_documents(spark, sf_dir):
    documents, _ = _listed(spark, sf_dir)
    return documents.select("source_id", "url", F.unix_seconds("created_at").alias("created_s"))


@query(f"""WITH {_LISTINGS}, p AS (SELECT page, count(*) AS children, count(*) FILTER (WHERE conv_id % 7 > 0) AS posts, count(*) FILTER (WHERE conv_id % 7 > 0 AND n >= 5 AND conv_id % 11 > 0 AND conv_id % 13 = 0) AS bad FROM posts GROUP BY 1),
  c AS (SELECT page, count(*) FILTER (WHERE mapped) AS comments, count(*) FILTER (WHERE NOT mapped) AS unmapped_comments FROM walked GROUP BY 1)
  SELECT page, 'a' || page AS after, posts, children - posts AS unmapped, coalesce(comments, 0) AS comments, coalesce(unmapped_comments, 0) AS unmapped_comments,
  bad = 0 AND ((children - posts) * 2 >= children OR coalesce(comments + unmapped_comments > 0 AND unmapped_comments * 2 >= comments + unmapped_comments, false)) AS truncated, bad > 0 AS failed FROM p LEFT JOIN c USING (page)""")
def listing_report(spark, sf_dir):
    _, report = _listed(spark, sf_dir)
    return report.select("page", "after", "posts", "unmapped", "comments", "unmapped_comments", "truncated", "failed")


@query("""WITH n AS (SELECT count(DISTINCT event_type) * 2 AS n FROM events), r AS (SELECT i * 2 + l.o AS ordinal, event_type AS community, l.listing FROM (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS i FROM (SELECT DISTINCT event_type FROM events)), (VALUES (0, 'new'), (1, 'top')) l(o, listing)),
  s AS (SELECT event_id, event_id % n.n AS pos, CASE WHEN event_id % 5 = 0 THEN 'g' || event_id END AS given, CASE WHEN event_id % 3 = 0 THEN 'n' || event_id END AS after, event_id % 7 = 0 AS failed FROM events, n),
  t AS (SELECT event_id, CASE WHEN failed OR after IS NOT NULL THEN pos ELSE pos + 1 END AS ordinal, CASE WHEN failed THEN given ELSE after END AS place FROM s)
  SELECT event_id, community, listing, CASE WHEN community IS NOT NULL THEN place END AS place FROM t LEFT JOIN r USING (ordinal)""")
def listing_round_next(spark, sf_dir):
    """Where the round over (community, listing) goes on after each page."""
    e, i = _events(spark, sf_dir), F.col("event_id")
    communities = e.select(F.col("source").alias("community")).distinct()
    listings = spark.createDataFrame([("new",), ("top",)], "listing string")
    pairs = windows.pairs(communities, listings)
    read = e.select("event_id", (i % pairs.count()).alias("at"), F.when(i % 5 == 0, F.concat(F.lit("g"), i.cast("string"))).alias("given"), F.when(i % 3 == 0, F.concat(F.lit("n"), i.cast("string"))).alias("after"), (i % 7 == 0).alias("failed"))
    return windows.next_places(read, pairs).select("event_id", "community", "listing", "place")


# --- what the sink reports -------------------------------------------------------------------------------------------

@query(f"""WITH o AS (SELECT *, event_id < 500 AS stored, row_number() OVER (PARTITION BY source, event_id ORDER BY page) AS rn FROM ({_PAGES}))
  SELECT source, count(*) AS fetched, count(*) FILTER (WHERE NOT stored AND rn = 1) AS inserted, count(*) FILTER (WHERE stored OR rn > 1) AS duplicates FROM o GROUP BY 1""")
def ingest_counts_against_store(spark, sf_dir):
    offered = _two_pages(spark, sf_dir)
    return store.reported(offered, _events(spark, sf_dir).filter("event_id < 500"))


@query(f"""SELECT run, source, count(*) AS pages, CAST(sum(offered) AS BIGINT) AS fetched, list(reason ORDER BY page) FILTER (WHERE reason IS NOT NULL) AS truncated_reasons
  FROM (SELECT *, CASE WHEN partial THEN 'page ' || page END AS reason, min(CASE WHEN why IS NOT NULL THEN page END) OVER (PARTITION BY run, source) AS e FROM (SELECT *, {_WHY} AS why FROM ({_LOG}) WHERE page <= 25)) WHERE e IS NULL OR page <= e GROUP BY 1, 2""".replace(
    "list(reason ORDER BY page) FILTER (WHERE reason IS NOT NULL)", "coalesce(string_agg(reason, ';' ORDER BY page), '')"))
def page_counters(spark, sf_dir):
    """Counters over the pages of a source that were read, with the reasons of truncated ones in order."""
    log = _page_log(spark, sf_dir).withColumn("truncated", F.when(F.col("partial"), F.concat(F.lit("page "), F.col("page").cast("string"))))
    return runs.counters(log).select("run", "source", "pages", F.col("fetched").cast("long").alias("fetched"), F.array_join("truncated_reasons", ";").alias("truncated_reasons"))


@query("""SELECT kind, count(*) AS n FROM (SELECT CASE doc_id % 6 WHEN 0 THEN 'not-an-object' WHEN 1 THEN 'shape' WHEN 2 THEN 'shape' WHEN 3 THEN 'rating' WHEN 4 THEN 'date' ELSE 'document' END AS kind FROM documents) GROUP BY 1""")
def review_reject_classes(spark, sf_dir):
    """Every way in which a review can be rejected."""
    i, label = F.col("doc_id"), lambda c: F.struct(c.alias("label"))
    entry = F.to_json(F.struct(label(F.when(i % 6 != 1, i.cast("string"))).alias("id"), F.struct(label(F.col("source")).alias("name")).alias("author"), label(F.when(i % 6 == 4, "soon").otherwise("2024-01-02T03:04:05-07:00")).alias("updated"),
                               label(F.when(i % 6 != 2, F.col("lang"))).alias("content"), label(F.when(i % 6 == 3, "0").otherwise("5")).alias("im:rating")))
    rows = _t(spark, sf_dir, "documents").select("doc_id", F.lit("42").alias("app_id"), F.lit("us").alias("territory"), F.when(i % 6 == 0, "[1]").otherwise(entry).alias("entry"))
    done = normalize.reviews(rows)
    return done.groupBy(F.coalesce("reject", F.lit("document")).alias("kind")).agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN k = 'plain' AND id % 4 = 0 THEN false ELSE true END AS mapped, k, count(*) AS n FROM (SELECT event_id AS id, unnest(['plain', 'linked']) AS k FROM events) GROUP BY 1, 2""")
def normalize_comments(spark, sf_dir):
    """Comments with and without a link of their own; those without a body can't be mapped."""
    i = F.col("event_id")
    own = lambda k: [i.cast("string").alias("id"), F.concat(F.lit("t1_"), i.cast("string")).alias("name"), F.when((i % 4 > 0) | (F.lit(k) == "linked"), F.col("source")).alias("body"), F.lit(1).alias("created_utc")]
    made = [_events(spark, sf_dir).select(F.lit(k).alias("k"), F.lit("/r/x/p/").alias("post_permalink"), F.to_json(F.struct(*own(k), *([F.lit("/r/x/own/").alias("permalink")] if k == "linked" else []))).alias("data")) for k in ("plain", "linked")]
    done = normalize.comments(reduce(DataFrame.unionByName, made))
    linked = F.col("url").endswith("/r/x/own/") == (F.col("k") == "linked")
    return done.filter(linked | ~F.col("mapped")).groupBy("mapped", "k").agg(F.count("*").alias("n"))


# --- analytics that the specification asks for -----------------------------------------------------------------------

_SEEDED = """v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), s AS (SELECT e FROM v WHERE vec_id % 100 = 0),
  m AS (SELECT vec_id, max(list_cosine_similarity(v.e, s.e)) AS similarity FROM v, s GROUP BY 1)"""


@query(f"""WITH {_SEEDED} SELECT doc_id, round(similarity, 6) AS similarity, CASE WHEN coalesce(round(similarity, 6) >= 0.4, false) OR regexp_matches(lower(coalesce(text, '')), 'token|license') THEN 'candidate' ELSE 'noise' END AS verdict
  FROM documents LEFT JOIN m ON vec_id = doc_id""")
def seed_prefilter(spark, sf_dir):
    """Documents by the likeness of their vectors to a seed set, and by the words of their texts."""
    v = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    scored = insight.seed_similarity(v, v.filter("id % 100 = 0")).select("id", F.round("similarity", 6).alias("similarity"))
    joined = _t(spark, sf_dir, "documents").join(scored, F.col("doc_id") == F.col("id"), "left")
    like = F.coalesce("similarity", F.lit(-2.0))
    return joined.select("doc_id", "similarity", insight.prefilter(like, F.coalesce("text", F.lit("")), 0.4, "token|license").alias("verdict"))


@query("""SELECT o_orderpriority AS stage, count(*) AS runs, CAST(sum(o_orderkey % 600) AS BIGINT) AS seconds, CAST(max(o_orderkey % 600) AS BIGINT) AS longest, CAST(sum(o_custkey) AS BIGINT) AS rows_in, CAST(sum(o_custkey - o_custkey % 3) AS BIGINT) AS rows_out,
  CAST(sum(o_custkey % 3) AS BIGINT) AS errors, CAST(sum(CAST(o_totalprice AS DECIMAL(20,2))) AS DECIMAL(30,2)) AS cost_usd, round(sum(o_custkey % 3) / CAST(sum(o_custkey) AS DOUBLE), 6) AS error_rate FROM orders GROUP BY 1""")
def stage_metrics(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    made = o.select(F.col("o_orderpriority").alias("stage"), (F.col("o_orderkey") % 600).alias("seconds"), F.col("o_custkey").alias("rows_in"), (F.col("o_custkey") - F.col("o_custkey") % 3).alias("rows_out"),
                    (F.col("o_custkey") % 3).alias("errors"), F.col("o_totalprice").cast("decimal(20,2)").alias("cost_usd"))
    done = cost.stage_metrics(made)
    whole = {c: F.col(c).cast("long") for c in ("seconds", "longest", "rows_in", "rows_out", "errors")}
    return done.withColumns({**whole, "cost_usd": F.col("cost_usd").cast("decimal(30,2)")})


@query("""WITH d AS (SELECT date_trunc('day', o_orderdate) AS day, sum(CAST(o_totalprice AS DECIMAL(20,2))) AS c FROM orders GROUP BY 1),
  r AS (SELECT day, c, sum(c) OVER (ORDER BY day RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS spend FROM d)
  SELECT CAST(day AS DATE) AS day, CAST(spend AS DECIMAL(30,2)) AS spend, CAST(c * 30 AS DECIMAL(30,2)) AS projected, CASE WHEN c * 30 > 20000000.00 THEN 'over' WHEN c * 30 >= 20000000.00 * 0.80 THEN 'near' ELSE 'under' END AS verdict FROM r""")
def spend_projection(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderdate", F.col("o_orderpriority").alias("stage"), F.col("o_totalprice").cast("decimal(20,2)").alias("cost_usd"))
    p = cost.projection(o, F.lit("20000000.00").cast("decimal(20,2)"), "o_orderdate")
    return p.select(F.col("day").cast("date").alias("day"), F.col("spend").cast("decimal(30,2)").alias("spend"), F.col("projected").cast("decimal(30,2)").alias("projected"), "verdict")


def _scores(spark, sf_dir):
    """Customers as clusters, their orders as mentions and points, order priorities as sources."""
    o = _t(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_custkey").alias("cluster")).agg(F.count("*").alias("mentions"), F.sort_array(F.collect_set("o_orderpriority")).alias("sources"), F.sum(F.col("o_totalprice").cast("decimal(20,2)")).alias("composite"))


_TABLE = """t AS (SELECT cluster, mentions, composite, row_number() OVER (ORDER BY composite DESC, cluster) AS place FROM (SELECT o_custkey AS cluster, count(*) AS mentions, sum(CAST(o_totalprice AS DECIMAL(20,2))) AS composite,
  bool_or(o_orderpriority IN ('1-URGENT', '5-LOW')) AS there FROM orders GROUP BY 1) WHERE mentions >= 3 AND there ORDER BY composite DESC, cluster LIMIT 500)"""


@query(f"WITH {_TABLE} SELECT cluster, mentions, CAST(composite AS DECIMAL(30,2)) AS composite, place FROM t")
def ranked_opportunities(spark, sf_dir):
    table = insight.ranked(_scores(spark, sf_dir), least_mentions=3, sources=["1-URGENT", "5-LOW"], limit=500)
    return table.select("cluster", "mentions", F.col("composite").cast("decimal(30,2)").alias("composite"), F.col("place").cast("long").alias("place"))


@query("""SELECT cluster, domain, gap, CAST(composite AS DECIMAL(30,2)) AS composite, row_number() OVER (ORDER BY composite DESC, cluster) AS place FROM (
  SELECT o_custkey AS cluster, count(*) AS mentions, max(o_orderstatus) AS domain, sum(CAST(o_totalprice AS DECIMAL(20,2))) AS composite, min(o_orderdate) AS a, max(o_orderdate) AS b,
    CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') = 0 THEN 'none' WHEN count(*) FILTER (WHERE o_orderpriority = '1-URGENT') * 2 >= count(*) FILTER (WHERE o_orderstatus = 'F') THEN 'criticized' ELSE 'approved' END AS gap
  FROM orders GROUP BY 1) WHERE mentions >= 2 AND domain IN ('O', 'P') AND gap IN ('approved', 'criticized') AND b >= TIMESTAMP '1995-01-01' AND a <= TIMESTAMP '1997-12-31'""")
def ranked_by_domain_gap_and_dates(spark, sf_dir):
    """The whole ranked table under all filters."""
    gap = insight.solution_gap(F.count_if(F.col("o_orderstatus") == "F"), F.count_if(F.col("o_orderpriority") == "1-URGENT"))
    scores = _t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("cluster")).agg(
        F.count("*").alias("mentions"), F.max("o_orderstatus").alias("domain"), F.sum(F.col("o_totalprice").cast("decimal(20,2)")).alias("composite"), gap.alias("gap"),
        F.min(F.col("o_orderdate").cast("timestamp")).alias("first_seen"), F.max(F.col("o_orderdate").cast("timestamp")).alias("last_seen"))
    table = insight.ranked(scores, least_mentions=2, domains=["O", "P"], gaps=["approved", "criticized"], since="1995-01-01", until="1997-12-31")
    return table.select("cluster", "domain", "gap", F.col("composite").cast("decimal(30,2)").alias("composite"), "place")


@query(f"WITH {_TABLE} SELECT place, cluster, o_orderkey AS point, l_partkey AS document FROM t JOIN orders ON o_custkey = cluster JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey")
def opportunity_drill_down(spark, sf_dir):
    table = insight.ranked(_scores(spark, sf_dir), least_mentions=3, sources=["1-URGENT", "5-LOW"], limit=500)
    members = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cluster"), F.col("o_orderkey").alias("point"))
    points = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("point")).agg(F.collect_list("l_partkey").alias("source_document_ids"))
    parts = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.lit("x").alias("source"))
    return insight.drill_down(table, members, points, parts).select(F.col("place").cast("long").alias("place"), "cluster", "point", "document")


def _gains(order: str) -> str:
    return f"""SELECT source, round(CASE WHEN sum(quality / log2(i + 1)) > 0 THEN sum(quality / log2(rank + 1)) / sum(quality / log2(i + 1)) ELSE 0 END, 6) AS ndcg FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY quality DESC, rank) AS i
  FROM (SELECT source, quality, row_number() OVER (PARTITION BY source ORDER BY {order}, doc_id) AS rank FROM labels JOIN documents USING (doc_id))) GROUP BY 1"""


@query(f"""SELECT source, b.ndcg AS before, a.ndcg AS after, round(a.ndcg - b.ndcg, 6) AS change, round(a.ndcg - b.ndcg, 6) < -0.02 AS regressed FROM ({_gains('n_chars DESC')}) b JOIN ({_gains('n_chars')}) a USING (source)""")
def calibration_gate(spark, sf_dir):
    """The ranking quality of two weightings, source by source, and what a change of weights would make worse."""
    d = _t(spark, sf_dir, "labels").join(_t(spark, sf_dir, "documents"), "doc_id").select("source", "quality", "n_chars", "doc_id")
    by = lambda first: insight.ndcg(d.select("source", "quality", F.row_number().over(Window.partitionBy("source").orderBy(first, "doc_id")).alias("rank")), "source", gain="quality")
    return insight.gate(by(F.desc("n_chars")), by(F.asc("n_chars")), "source", "ndcg", 0.02)


@query("""SELECT c AS cluster, CAST(score AS DECIMAL(30,2)) AS composite, CASE WHEN cited > 0 THEN missing ELSE 0 END AS missing, CASE WHEN cited = 0 THEN 'withheld: no citation' WHEN missing > 0 THEN 'withheld: citation not found' ELSE 'published' END AS state FROM (SELECT doc_id % 50 AS c, sum(n_chars) AS score,
  count(*) FILTER (WHERE doc_id % 50 % 9 <> 0) AS cited, count(*) FILTER (WHERE doc_id % 50 % 9 <> 0 AND doc_id % 31 = 0) AS missing FROM documents GROUP BY 1) WHERE score >= 8000""")
def briefs_due(spark, sf_dir):
    """Briefs of clusters beyond the threshold; those whose citations don't hold are withheld."""
    d, cluster = _t(spark, sf_dir, "documents"), F.col("doc_id") % 50
    scores = d.groupBy(cluster.alias("cluster")).agg(F.sum("n_chars").alias("composite"))
    span = F.when(F.col("doc_id") % 31 == 0, "no text has this span").otherwise(F.substring("text", 3, 40))
    cited = d.filter(cluster % 9 != 0).select(cluster.alias("brief"), F.col("doc_id").alias("document_id"), span.alias("span"))
    checked = insight.citations(cited, d.select(F.col("doc_id").alias("id"), F.col("text").alias("body")))
    return insight.briefs(scores, checked, 8000).withColumn("composite", F.col("composite").cast("decimal(30,2)"))


# --- catalogue and jobs ----------------------------------------------------------------------------------------------

@query("""SELECT * FROM (VALUES ('documents', 'created_at'), ('documents', 'ingested_at'), ('source_cursors', 'updated_at'), ('runs', 'started_at')) t(name, "column")""")
def required_times(spark, sf_dir):
    """Columns of some tables that end in _at and can't be null."""
    from evidora.schemas import columns

    some = columns(spark).filter(F.col("name").isin("documents", "source_cursors", "runs") & ~F.col("nullable") & F.col("column").endswith("_at"))
    return some.select("name", "column")


@query("""SELECT event_id FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-02-20 12:00:00' - INTERVAL 720 HOURS""")
def dead_letters_kept(spark, sf_dir):
    letters = _events(spark, sf_dir).filter("source = 'error'")
    return policy.kept_letters(letters, F.expr("TIMESTAMP_NTZ '2024-02-20 12:00:00'"), at="ts").select("event_id")


# --- clusters that take in runs by merging sketches -------------------------------------------------------------------

def _at_rank(rank: float) -> str:
    return f"list_sort(list(CAST(l_quantity AS DOUBLE)))[CAST(ceil({rank} * count(l_quantity)) AS INTEGER)]"


@query(f"""SELECT CAST(l_suppkey AS BIGINT) AS cluster, year(max(l_shipdate)) AS run, count(*) AS mentions, count(DISTINCT l_orderkey) AS documents, count(DISTINCT l_returnflag) AS sources,
  {_at_rank(0.5)} AS median, {_at_rank(0.9)} AS high FROM lineitem WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY l_suppkey""")
def cluster_statistics_merged(spark, sf_dir):
    """Suppliers as clusters, years as runs: the first years make the state, later ones are taken in, the last one twice."""
    evidence = _t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("long").alias("cluster"), F.year("l_shipdate").alias("run"), "l_orderkey", "l_returnflag", "l_quantity")
    made = written(sketches.sketched(evidence, "cluster", "run", "l_orderkey", "l_returnflag", "l_quantity"))
    early, late = made.filter("run < 1995"), made.filter("run >= 1995")
    state = sketches.taken_in(sketches.over_runs(early), late)
    return sketches.statistics(sketches.taken_in(state, late))


# --- positions, headroom, projected cost, references -----------------------------------------------------------------

@query("""WITH p AS (SELECT event_type AS name, row_number() OVER (ORDER BY event_type) - 1 AS ordinal FROM (SELECT DISTINCT event_type FROM events)),
  c AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'start' WHEN event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 THEN 'malformed' WHEN event_id % 7 = 0 THEN 'restart' ELSE 'resume' END AS outcome, event_type AS name,
    CASE WHEN event_id % 3 > 0 THEN 't' || event_id END AS after FROM events)
  SELECT event_id, outcome, CASE outcome WHEN 'resume' THEN ordinal WHEN 'malformed' THEN NULL ELSE 0 END AS ordinal, CASE WHEN outcome = 'resume' THEN after END AS after FROM c JOIN p USING (name)""")
def backfill_resume(spark, sf_dir):
    """Event types as communities; cursors of one with a listing, without a position, unreadable, of an unknown one, or none."""
    e, i = _events(spark, sf_dir), F.col("event_id")
    places = windows.pairs(e.select(F.col("source").alias("name")).distinct(), spark.range(1).select(F.lit("backfill").alias("mode")))
    after = F.when(i % 3 > 0, F.concat(F.lit('"t'), i.cast("string"), F.lit('"'))).otherwise("null")
    name = F.when(i % 7 == 0, F.concat(F.lit("gone-"), "source")).otherwise(F.col("source"))
    whole = F.format_string('{"subreddit":"%s","after":%s}', name, after)
    cursor = (F.when(i % 11 == 0, None).when(i % 13 == 0, F.format_string('{"subreddit":"%s","listing":"new","after":%s}', name, after))
              .when(i % 17 == 0, F.format_string('{"subreddit":"%s"}', name)).when(i % 19 == 0, F.lit("{no cursor")).otherwise(whole))
    return windows.backfill_positions(e.select("event_id", cursor.alias("cursor")), "cursor", places).select("event_id", "outcome", F.col("ordinal").cast("long").alias("ordinal"), "after")


@query("""SELECT conv_id AS page, arg_max(length(text), turn) FILTER (WHERE turn % 3 <> 2 AND text IS NOT NULL) AS headroom FROM conversations GROUP BY 1""")
def last_headroom(spark, sf_dir):
    """Of each page the headroom that its last thread told; every third one tells none."""
    c = _t(spark, sf_dir, "conversations")
    return insight.last_known(c.select(F.col("conv_id").alias("page"), "turn", F.when(F.col("turn") % 3 != 2, F.length("text")).cast("long").alias("headroom")), "page", "turn", "headroom")


@query("""SELECT round(avg(n_chars / 4.0) * 30000 * 0.02 / 1e6, 4) AS projected_usd FROM documents""")
def embedding_month_cost(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select((F.col("n_chars") / 4.0).alias("tokens"))
    return insight.cost_projection(d, 30_000, "0.02")


#: child table, its column, parent table, its key.
_REFERENCES = [("nation", "n_regionkey", "region", "r_regionkey"), ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"), ("orders", "o_custkey", "customer", "c_custkey"),
               ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("labels", "doc_id", "documents", "doc_id")]
_HELD = " UNION ALL ".join(f"SELECT '{c}' AS child, '{k}' AS col, '{p}' AS parent, (SELECT count(*) FROM {c}) AS n, (SELECT count(*) FROM {c} x WHERE NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{key} = x.{k})) AS orphans" for c, k, p, key in _REFERENCES)


def _references(spark, sf_dir):
    def edge(child, column, parent, key):
        own, other = _t(spark, sf_dir, child).select(F.col(column).alias("_k")), _t(spark, sf_dir, parent).select(F.col(key).alias("_p")).distinct()
        met = own.groupBy("_k").agg(F.count("*").alias("_n")).join(other, F.col("_k") == F.col("_p"), "left")
        sums = met.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("_p").isNull(), F.col("_n"))), F.lit(0)).alias("orphans"))
        return sums.select(F.lit(child).alias("child"), F.lit(column).alias("col"), F.lit(parent).alias("parent"), "n", "orphans")

    return reduce(DataFrame.unionByName, [edge(*r) for r in _REFERENCES])


@query(_HELD)
def reference_orphans(spark, sf_dir):
    """For each reference between tables its rows and those that point to nothing, nulls among them."""
    return _references(spark, sf_dir)


@query(f"""WITH RECURSIVE e AS (SELECT child, parent FROM ({_HELD}) WHERE orphans = 0), w(name, root) AS (SELECT child, parent FROM e UNION SELECT e.child, w.root FROM w JOIN e ON e.parent = w.name) SELECT name, root FROM w""")
def references_reach(spark, sf_dir):
    """Which tables lead to which by references that hold in the data."""
    from evidora.schemas import closure

    return closure(spark, written(_references(spark, sf_dir).filter("orphans = 0").select("child", "parent").distinct()))


def _null_counts() -> str:
    tables = {"documents": ["doc_id", "text", "lang", "source", "n_chars"], "events": ["event_id", "ts", "user_id", "event_type", "value", "props"], "conversations": ["conv_id", "turn", "role", "text"], "labels": ["doc_id", "quality", "toxic"]}
    return " UNION ALL ".join(f"SELECT '{t}' AS name, '{c}' AS col, count(*) AS n, count(*) - count({c}) AS missing FROM {t}" for t, cs in tables.items() for c in cs)


@query(f"SELECT name, col, missing FROM ({_null_counts()}) WHERE missing = 0")
def columns_without_null(spark, sf_dir):
    """The columns of the text tables that could be declared not null: one pass a table."""
    from evidora.schemas import null_counts

    return null_counts({t: _t(spark, sf_dir, t) for t in ("documents", "events", "conversations", "labels")}).filter("missing = 0").select("name", "col", "missing")
