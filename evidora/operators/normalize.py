"""Source payloads to documents: strict checks, reject classes, and the mapping of the four payload shapes.

Payloads are JSON texts. A field of the wrong type rejects its row; nothing is coerced. Rejected rows stay in the
result with their class, so a caller can count them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidora.functions.columns import (
    blank_to_null, field, from_seconds, is_optional, kind_of, number_at, prefixed_author, reviews_url, string_at, without,
)

DOCUMENT_COLUMNS = ("source", "source_id", "url", "author_handle", "title", "body", "created_at", "engagement", "raw")

#: Above this share of rows that can't be read, a page is reported as truncated.
SHORTFALL = 0.5


def _number_text(number: Column) -> Column:
    """A number as JSON writes it: whole numbers without a point."""
    return F.transform(F.array(number), lambda x: F.when(x == F.floor(x), x.cast("decimal(38,0)").cast("string")).otherwise(x.cast("string")))[0]


def parsed(rows: DataFrame, json: str) -> DataFrame:
    """``rows`` with ``_v``, the variant of a JSON text, which is parsed once however often ``_v`` is named."""
    return once(rows, "_v", F.try_parse_json(json))


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with ``name``: a generated column, into which the optimiser can't copy its expression or push filters."""
    return rows.withColumn(name, F.explode(F.array(value)))


def hydration_class(status: Column, v: Column) -> Column:
    """document, filtered, transient-failure or malformed, in the order in which an item (a variant) is examined."""
    required = (kind_of(v, "$.id") == "NUMBER") & (kind_of(v, "$.type") == "STRING") & (kind_of(v, "$.time") == "NUMBER")
    optional = [("by", "STRING"), ("deleted", "BOOLEAN"), ("dead", "BOOLEAN"), ("text", "STRING"), ("title", "STRING"), ("url", "STRING"), ("score", "NUMBER"), ("descendants", "NUMBER"), ("kids", "ARRAY")]
    shaped = F.coalesce(required, F.lit(False))
    for name, kind in optional:
        shaped = shaped & is_optional(v, f"$.{name}", kind)
    kids = F.try_variant_get(v, "$.kids", "array<variant>")
    numeric_kids = F.coalesce(F.forall(kids, lambda k: F.schema_of_variant(k).rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)")), F.lit(True))
    flag = lambda name: F.coalesce(F.try_variant_get(v, f"$.{name}", "boolean"), F.lit(False))
    return (F.when(status != 200, "transient-failure")
            .when(F.schema_of_variant(v) == "VOID", "filtered")
            .when(v.isNull() | ~shaped | ~numeric_kids, "malformed")
            .when(flag("deleted") | flag("dead"), "filtered")
            .when(~string_at(v, "$.type").isin("story", "comment"), "filtered")
            .otherwise("document"))


def items(rows: DataFrame, status: str = "status", body: str = "body") -> DataFrame:
    """``rows`` with ``outcome`` and, where it is document, the document's columns (null elsewhere)."""
    v = F.col("_v")
    story = string_at(v, "$.type") == "story"
    number = lambda name: F.coalesce(number_at(v, f"$.{name}"), F.lit(0.0)).cast("long")
    kids = F.coalesce(F.size(F.try_variant_get(v, "$.kids", "array<variant>")), F.lit(0)).cast("long")
    marked = once(parsed(rows, body), "outcome", hydration_class(F.col(status), v))
    key = _number_text(number_at(v, "$.id"))
    columns = {
        "source": F.lit("hackernews"), "source_id": key, "url": F.concat(F.lit("https://news.ycombinator.com/item?id="), key),
        "author_handle": string_at(v, "$.by"), "title": F.when(story, string_at(v, "$.title")), "body": F.coalesce(string_at(v, "$.text"), F.lit("")),
        "created_at": from_seconds(number_at(v, "$.time")),
        "engagement": F.when(story, F.to_json(F.struct(number("score").alias("points"), number("descendants").alias("commentCount")))).otherwise(F.to_json(F.struct(kids.alias("replyCount")))),
        "raw": F.col(body),
    }
    keep = [c for c in rows.columns if c not in {*columns, status, body}]
    return marked.select(*keep, "outcome", *[F.when(F.col("outcome") == "document", c).alias(n) for n, c in columns.items()])


def feed_entries(pages: DataFrame, body: str = "body") -> DataFrame:
    """``pages`` exploded to ``pos`` and ``entry`` (JSON text): none, a bare object or an array in ``feed.entry``.

    ``usable`` is false, and entry null, for a page that is not JSON or has no feed.
    """
    v = F.col("_v")
    usable = F.coalesce(kind_of(v, "$.feed") == "OBJECT", F.lit(False))
    entry = field(v, "$.feed.entry")
    listed = F.when(kind_of(v, "$.feed.entry") == "ARRAY", F.try_variant_get(v, "$.feed.entry", "array<variant>")).when(entry.isNotNull(), F.array(entry))
    texts = F.transform(F.when(usable, listed), lambda e: F.to_json(e))
    keep = [c for c in pages.columns if c != body]
    return parsed(pages, body).select(*keep, usable.alias("usable"), F.posexplode_outer(texts).alias("pos", "entry"))


def reviews(entries: DataFrame, app: str = "app_id", territory: str = "territory", entry: str = "entry") -> DataFrame:
    """Review entries with ``reject`` (null for a document, else not-an-object, shape, rating or date) and the document's columns."""
    v = F.col("_v")
    label = lambda name: string_at(v, f"$['{name}'].label")
    optional = lambda name: is_optional(v, f"$['{name}']", "OBJECT") & (kind_of(v, f"$['{name}']").isNull() | label(name).isNotNull())
    author = string_at(v, "$.author.name.label")
    shaped = label("id").isNotNull() & author.isNotNull() & label("updated").isNotNull() & label("content").isNotNull() & label("im:rating").isNotNull()
    shaped = shaped & optional("title") & optional("im:voteCount") & optional("im:voteSum")
    rating = F.trim(label("im:rating")).try_cast("double")
    created = F.try_to_timestamp(label("updated"))
    reject = (F.when(F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)) == F.lit(False), "not-an-object")
              .when(~F.coalesce(shaped, F.lit(False)), "shape")
              .when(~F.coalesce((rating == F.floor(rating)) & rating.between(1, 5), F.lit(False)), "rating")
              .when(created.isNull(), "date"))
    votes = lambda name: F.when(label(name).isNull(), 0).when(F.trim(label(name)) == "", 0).otherwise(F.trim(label(name)).try_cast("double").cast("long"))
    stripped = F.when(kind_of(v, "$.author.uri").isNotNull(), F.to_json(F.map_concat(
        F.map_filter(F.from_json(F.col(entry), "map<string,variant>"), lambda k, _: k != "author"),
        F.create_map(F.lit("author"), F.parse_json(without(F.to_json(field(v, "$.author")), "uri")))))).otherwise(F.col(entry))
    columns = {
        "source": F.lit("appstore"), "source_id": label("id"), "url": reviews_url(F.col(app), F.col(territory)), "author_handle": blank_to_null(author),
        "title": blank_to_null(label("title")), "body": label("content"), "created_at": created,
        "engagement": F.to_json(F.struct(rating.cast("long").alias("rating"), votes("im:voteCount").alias("voteCount"), votes("im:voteSum").alias("voteSum"))),
        "raw": stripped,
    }
    marked = once(parsed(entries, entry), "reject", reject)
    keep = [c for c in entries.columns if c not in {*columns, entry}]
    return marked.select(*keep, "reject", *[F.when(F.col("reject").isNull(), c).alias(n) for n, c in columns.items()])


def listing_children(pages: DataFrame, body: str = "body") -> DataFrame:
    """``pages`` exploded to ``pos`` and ``data`` (JSON text) of the readable children; ``child_count`` counts all, ``after`` is the next position."""
    v = F.col("_v")
    children = F.try_variant_get(v, "$.data.children", "array<variant>")
    data = F.filter(F.transform(children, lambda c: F.when(kind_of(c, "$.data") == "OBJECT", F.to_json(field(c, "$.data")))), lambda d: d.isNotNull())
    keep = [c for c in pages.columns if c != body]
    return parsed(pages, body).select(*keep, (kind_of(v, "$.data.children") == "ARRAY").alias("usable"), F.coalesce(F.size(children), F.lit(0)).alias("child_count"),
                        string_at(v, "$.data.after").alias("after"), F.posexplode_outer(data).alias("pos", "data"))


def _thing(v: Column, url: Column, title: Column, body: Column, engagement: Column, raw: Column) -> dict[str, Column]:
    return {"source": F.lit("reddit"), "source_id": string_at(v, "$.name"), "url": F.concat(F.lit("https://www.reddit.com"), url),
            "author_handle": prefixed_author(string_at(v, "$.author")), "title": title, "body": body,
            "created_at": from_seconds(number_at(v, "$.created_utc")), "engagement": engagement, "raw": raw}


#: Identity keys that are left out of ``raw``: ids that resolve an account across communities.
IDENTITY = ("author_fullname",)


def _mapped(rows: DataFrame, ok: Column, columns: dict[str, Column], drop: str, extra: dict[str, Column]) -> DataFrame:
    marked = once(parsed(rows, drop), "mapped", F.coalesce(ok, F.lit(False)))
    keep = [c for c in rows.columns if c not in {*columns, *extra, drop, "mapped"}]
    return marked.select(*keep, "mapped", *[F.when(F.col("mapped"), c).alias(n) for n, c in {**columns, **extra}.items()])


def posts(rows: DataFrame, data: str = "data") -> DataFrame:
    """Post nodes with ``mapped``, the document's columns, ``post_id``, ``permalink`` and ``num_comments``."""
    v = F.col("_v")
    text = lambda name: string_at(v, f"$.{name}")
    number = lambda name: number_at(v, f"$.{name}")
    ok = text("id").isNotNull() & text("name").isNotNull() & text("permalink").isNotNull() & text("title").isNotNull() & number("created_utc").isNotNull()
    count = F.coalesce(number("num_comments"), F.lit(0.0)).cast("long")
    engagement = F.to_json(F.struct(F.coalesce(number("score"), F.lit(0.0)).cast("long").alias("score"), count.alias("numComments"), number("upvote_ratio").alias("upvoteRatio")))  # a null key is left out
    columns = _thing(v, text("permalink"), text("title"), F.coalesce(text("selftext"), F.lit("")), engagement, without(F.col(data), *IDENTITY))
    return _mapped(rows, ok, columns, data, {"post_id": text("id"), "permalink": text("permalink"), "num_comments": count})


def comments(rows: DataFrame, data: str = "data", post_permalink: str = "post_permalink") -> DataFrame:
    """Comment nodes with ``mapped`` and the document's columns; a missing permalink is made from the post's."""
    v = F.col("_v")
    text = lambda name: string_at(v, f"$.{name}")
    ok = text("id").isNotNull() & text("name").isNotNull() & text("body").isNotNull() & number_at(v, "$.created_utc").isNotNull()
    link = F.coalesce(text("permalink"), F.concat(F.col(post_permalink), text("id"), F.lit("/")))
    engagement = F.to_json(F.struct(F.coalesce(number_at(v, "$.score"), F.lit(0.0)).cast("long").alias("score")))
    columns = _thing(v, link, F.lit(None).cast("string"), text("body"), engagement, without(F.col(data), "replies", *IDENTITY))
    return _mapped(rows, ok, columns, data, {})


def shortfall(skipped: Column, candidates: Column) -> Column:
    """Whether half of what was tried, or more, could not be read."""
    return F.coalesce((candidates > 0) & (skipped / candidates >= SHORTFALL), F.lit(False))
