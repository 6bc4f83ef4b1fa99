"""Bounded walks of comment trees: depth counted from 1 at the top, breadth counted by siblings that could be mapped."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidora.functions.columns import field, kind_of
from evidora.operators.normalize import comments
from evidora.shared import written

MAX_DEPTH, MAX_BREADTH, MIN_COMMENTS = 2, 5, 5


def _within_breadth(rows: DataFrame, siblings: list[str], pos: str, mapped: str, breadth: int) -> DataFrame:
    """Rows up to the place where ``breadth`` siblings have been taken; rows that can't be mapped don't use it up."""
    before = Window.partitionBy(*siblings).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum(F.col(mapped).cast("int")).over(before), F.lit(0))
    return rows.withColumn("_taken", taken).filter(F.col("_taken") < breadth).drop("_taken")


def walk_edges(nodes: DataFrame, tree: str, node: str, parent: str, pos: str, depth: int = MAX_DEPTH, breadth: int = MAX_BREADTH, mapped: str | None = None) -> DataFrame:
    """Nodes reached from the roots (parent null) of each ``tree``, with ``depth`` and ``path`` (positions, in pre-order).

    The breadth rank doesn't depend on the walk, so it is taken once and written; each level then is one join on
    (tree, parent).
    """
    flag = mapped or "_mapped"
    ranked = nodes if mapped else nodes.withColumn(flag, F.lit(True))
    near = _within_breadth(ranked, [tree, parent], pos, flag, breadth)
    near = written(near) if depth > 1 else near
    level = near.filter(F.col(parent).isNull()).withColumn("depth", F.lit(1)).withColumn("path", F.array(F.col(pos).cast("long")))
    found = level
    for d in range(2, depth + 1):
        up = level.filter(flag).select(F.col(tree).alias("_tree"), F.col(node).alias("_node"), F.col("path").alias("_path"))
        below = near.filter(F.col(parent).isNotNull()).join(up, (F.col(tree) == F.col("_tree")) & (F.col(parent) == F.col("_node")))
        level = below.withColumn("depth", F.lit(d)).withColumn("path", F.concat("_path", F.array(F.col(pos).cast("long")))).select(*near.columns, "depth", "path")
        found = found.unionByName(level)
    return found if mapped else found.drop(flag)


def walk_threads(threads: DataFrame, body: str = "body", permalink: str = "permalink", depth: int = MAX_DEPTH, breadth: int = MAX_BREADTH) -> DataFrame:
    """Comment rows of two-listing responses: every candidate tried, with ``mapped``, ``depth``, ``path`` and the document's columns.

    ``threads`` has ``thread`` (its id), the response and the post's permalink. A response of another shape has no rows.
    """
    v = F.try_parse_json(F.col(body))
    level = threads.select("thread", F.col(permalink).alias("post_permalink"), F.array().cast("array<long>").alias("above"), F.try_variant_get(v, "$[1].data.children", "array<variant>").alias("children"))
    out = None
    for d in range(1, depth + 1):
        child = level.select("thread", "post_permalink", "above", F.posexplode("children").alias("pos", "child"))
        kept = child.filter((F.try_variant_get("child", "$.kind", "string") == "t1") & (kind_of(F.col("child"), "$.data") == "OBJECT"))
        data = field(F.col("child"), "$.data")
        ready = kept.select("thread", "post_permalink", "above", "pos", F.to_json(data).alias("data"), F.try_variant_get(data, "$.replies.data.children", "array<variant>").alias("children"))
        tried = comments(ready).withColumn("path", F.concat("above", F.array(F.col("pos").cast("long")))).withColumn("depth", F.lit(d))
        near = _within_breadth(tried, ["thread", "above"], "pos", "mapped", breadth)
        level = near.filter("mapped").select("thread", "post_permalink", F.col("path").alias("above"), "children")
        rows = near.drop("children", "above", "pos", "post_permalink")
        out = rows if out is None else out.unionByName(rows)
    return out


def qualifying(posts: DataFrame, least: int = MIN_COMMENTS, count: str = "num_comments") -> DataFrame:
    """Posts with comments enough to be expanded."""
    return posts.filter(F.col(count) >= least)


def expansion_error(results: DataFrame, page: str = "page") -> DataFrame:
    """Per page the error that is reported and how far the expansion went: the first error, but a rate limit ends it and takes its place.

    ``results`` has page, pos and error_code (null for none); RATE_LIMIT is the code of a rate limit.
    """
    limit = F.min(F.when(F.col("error_code") == "RATE_LIMIT", F.col("pos")))
    first = F.min_by("error_code", F.when(F.col("error_code").isNotNull(), F.col("pos")))
    grouped = results.groupBy(page).agg(limit.alias("stopped_at"), first.alias("first_error"), F.max("pos").alias("last"))
    return grouped.select(page, F.when(F.col("stopped_at").isNotNull(), "RATE_LIMIT").otherwise(F.col("first_error")).alias("error_code"), F.coalesce("stopped_at", "last").alias("last_pos"))
