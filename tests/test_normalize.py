import json

from pyspark.sql import functions as F

from evidora.functions import columns as C
from evidora.operators import normalize, tree
from tests_fixtures import comment, post, review

ITEM = {"id": 7, "type": "story", "time": 1700000000, "by": "ann", "title": "T", "score": 5, "descendants": 2, "parts": [1]}


def one(spark, status, body):
    text = body if isinstance(body, str) else json.dumps(body)
    return normalize.items(spark.createDataFrame([(status, text)], "status int, body string")).first()


def test_item_classes(spark):
    cases = [(503, ITEM, "transient-failure"), (200, "null", "filtered"), (200, "{", "malformed"), (200, {**ITEM, "id": "7"}, "malformed"), (200, {**ITEM, "by": None}, "malformed"), (200, {**ITEM, "kids": ["x"]}, "malformed"),
             (200, {**ITEM, "title": 5}, "malformed"), (200, {**ITEM, "deleted": True}, "filtered"), (200, {**ITEM, "dead": True, "type": "comment"}, "filtered"), (200, {**ITEM, "type": "job"}, "filtered"),
             (200, {**ITEM, "dead": False}, "document"), (200, {"id": 1, "type": "poll", "time": "x"}, "malformed"), (404, "null", "transient-failure")]
    rows = spark.createDataFrame([(k, s, b if isinstance(b, str) else json.dumps(b)) for k, (s, b, _) in enumerate(cases)], "k int, status int, body string")
    got = {r.k: r.outcome for r in normalize.items(rows).collect()}
    assert got == {k: c for k, (_, _, c) in enumerate(cases)}


def test_items(spark):
    r = one(spark, 200, ITEM)
    assert (r.source, r.source_id, r.url, r.author_handle, r.title, r.body) == ("hackernews", "7", "https://news.ycombinator.com/item?id=7", "ann", "T", "")
    assert json.loads(r.engagement) == {"points": 5, "commentCount": 2} and json.loads(r.raw) == ITEM and r.created_at.timestamp() == 1700000000
    r = one(spark, 200, {"id": 8, "type": "comment", "time": 1700000000.5, "text": "b", "title": "no", "kids": [1, 2], "parent": 7})
    assert r.title is None and r.author_handle is None and json.loads(r.engagement) == {"replyCount": 2} and r.body == "b"
    assert json.loads(one(spark, 200, {"id": 9, "type": "story", "time": 1}).engagement) == {"points": 0, "commentCount": 0}


def test_reviews(spark):
    entries = [review(), review(**{"im:rating": {"label": " 5 "}, "im:voteCount": ..., "title": {"label": "  "}}), review(**{"im:rating": {"label": "4.5"}}), review(**{"im:rating": {"label": ""}}), review(**{"im:rating": {"label": "6"}}),
               review(updated={"label": "soon"}), review(content=...), review(title={"label": 5}), "text", review(author={"name": {"label": " "}})]
    rows = spark.createDataFrame([(k, "42", "us", json.dumps(e)) for k, e in enumerate(entries)], "k int, app_id string, territory string, entry string")
    got = {r.k: r for r in normalize.reviews(rows).collect()}
    assert [got[k].reject for k in range(10)] == [None, None, "rating", "rating", "rating", "date", "shape", "shape", "not-an-object", None]
    r = got[0]
    assert (r.source_id, r.author_handle, r.title, r.body, r.url) == ("r1", "Bo", "Hi", "text", "https://apps.apple.com/us/app/id42?see-all=reviews")
    assert json.loads(r.engagement) == {"rating": 4, "voteCount": 3, "voteSum": 1}
    raw = json.loads(r.raw)
    assert "uri" not in raw["author"] and raw["author"]["name"] == {"label": "Bo"} and raw["other"] == [1] and set(raw) == set(review())
    assert json.loads(got[1].engagement) == {"rating": 5, "voteCount": 0, "voteSum": 1} and got[1].title is None and got[9].author_handle is None


def test_feed_envelope(spark):
    bodies = [{"feed": {}}, {"feed": {"entry": review()}}, {"feed": {"entry": [review(), 5]}}, {"other": 1}, "not json"]
    rows = spark.createDataFrame([(k, b if isinstance(b, str) else json.dumps(b)) for k, b in enumerate(bodies)], "k int, body string")
    got = sorted((r.k, r.usable, r.pos, r.entry is not None) for r in normalize.feed_entries(rows).select("k", "usable", F.coalesce("pos", F.lit(-1)).alias("pos"), "entry").collect())
    assert got == [(0, True, -1, False), (1, True, 0, True), (2, True, 0, True), (2, True, 1, True), (3, False, -1, False), (4, False, -1, False)]


def test_listing_and_posts(spark):
    listing = {"kind": "Listing", "data": {"after": "t3_z", "children": [{"kind": "t3", "data": post()}, 5, {"kind": "t3"}, {"kind": "t3", "data": post(title=...)}, {"kind": "t3", "data": post(author="[deleted]", upvote_ratio=0.5, selftext="s")}]}}
    children = normalize.listing_children(spark.createDataFrame([(json.dumps(listing),)], "body string"))
    assert {(r.child_count, r.after, r.usable) for r in children.collect()} == {(5, "t3_z", True)}
    got = sorted(normalize.posts(children).collect(), key=lambda r: r.pos)
    assert [r.mapped for r in got] == [True, False, True]
    assert (got[0].source_id, got[0].url, got[0].author_handle, got[0].body, got[0].num_comments, got[0].post_id) == ("t3_a1", "https://www.reddit.com/r/x/a1/", "u/ann", "", 6, "a1")
    assert json.loads(got[0].engagement) == {"score": 3, "numComments": 6} and json.loads(got[2].engagement) == {"score": 3, "numComments": 6, "upvoteRatio": 0.5}
    assert got[2].author_handle is None and "author_fullname" not in json.loads(got[0].raw)


def test_threads(spark):
    deep = {"kind": "Listing", "data": {"children": [comment("c"), comment("d")]}}
    reply = {"kind": "Listing", "data": {"children": [comment("b", deep), {"kind": "more", "data": {}}]}}
    top = [comment("a", reply), comment("x", body=...), {"kind": "t3", "data": {}}, {"kind": "t1"}, comment("y", permalink="/own/"), comment("z")]
    body = [{"kind": "Listing"}, {"kind": "Listing", "data": {"children": top}}]
    threads = spark.createDataFrame([("t", "/r/x/1/", json.dumps(body)), ("bad", "/", "{}")], "thread string, permalink string, body string")
    got = sorted(tree.walk_threads(threads, depth=2, breadth=2).collect(), key=lambda r: r.path)
    assert [(r.body, r.mapped, r.depth) for r in got] == [("a", True, 1), ("b", True, 2), (None, False, 1), ("y", True, 1)]  # z is beyond the breadth
    assert got[0].url == "https://www.reddit.com/r/x/1/a/" and got[3].url == "https://www.reddit.com/own/" and "replies" not in json.loads(got[0].raw)


def test_scalar_functions(spark):
    f = spark.range(1).select(
        C.feed_url(F.lit("1"), F.lit("us"), F.lit(1)).alias("a"), C.feed_url(F.lit("1"), F.lit("us"), F.lit(3)).alias("b"), C.list_setting(F.lit(" x, ,y ")).alias("c"), C.list_setting(F.lit(" , ")).alias("d"),
        C.retry_after_ms(F.lit("7"), F.lit(0)).alias("e"), C.retry_after_ms(F.lit("Thu, 01 Jan 1970 00:00:09 GMT"), F.lit(4000)).alias("f"), C.retry_after_ms(F.lit("x"), F.lit(0)).alias("g"), C.retry_after_ms(F.lit("99999999999999"), F.lit(0)).alias("h"),
        C.cron_like(F.lit("*/15 * * * *")).alias("i"), C.cron_like(F.lit("* * * *")).alias("j"), C.integer_within(F.lit(" 7 "), 1, 9).alias("k"), C.integer_within(F.lit("7.0"), 1).alias("l"), C.postgres_url(F.lit("postgres://h/db")).alias("m"),
        C.retry_after_ms(F.lit("Thu, 01 Jan 1970 00:00:01 GMT"), F.lit(4000)).alias("n")).first()
    assert f.a == "https://itunes.apple.com/us/rss/customerreviews/id=1/sortby=mostrecent/json" and f.b == "https://itunes.apple.com/us/rss/customerreviews/page=3/id=1/sortby=mostrecent/json"
    assert tuple(f)[2:] == (["x", "y"], None, 7000, 5000, None, 30000, True, False, True, False, True, 0)
