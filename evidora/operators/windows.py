"""Incremental reads: time windows, capped pages, tie-safe boundaries, prefixes of ordered feeds.

Sort keys are whole seconds and not unique, so a boundary is a value, never a row. An ordinal column is asked for
wherever a rule says first, last or until.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidora.functions import columns as C

#: Seconds read back at first, seconds of index lag kept off, hits a page, pages a query, pages of a feed.
LOOKBACK, LAG = 24 * 3600, 60
PAGE_HITS, PAGES, FEED_PAGES = 1000, 20, 10
MALFORMED_RATIO = 0.5
#: Seconds of a query's hits that are put in order together.
SPAN = 3600
#: Settings that are paired on the driver's word that they are few.
PAIRED = 10_000


def window(kind: str, now: int | None = None, cursor: int | None = None, since: int | None = None, until: int | None = None) -> tuple[int, int, bool] | None:
    """(lower, upper, lower inclusive) of a read in seconds, or None where there is nothing to read.

    The upper bound always is inclusive. A resumed read excludes its lower bound, which has been covered.
    """
    if kind == "incremental":
        upper = int(now) - LAG
        lower = int(now) - LOOKBACK if cursor is None else cursor
        return None if upper <= lower else (lower, upper, cursor is None)
    lower = since if cursor is None else cursor
    return None if lower >= until else (lower, until, cursor is None)


def in_window(column: Column, bounds: tuple) -> Column:
    lower, upper, inclusive = bounds
    return (column >= lower if inclusive else column > lower) & (column <= upper)


def paged(hits: DataFrame, query: str, at: str, tie: str, size: int = PAGE_HITS, span: int = SPAN) -> DataFrame:
    """Hits newest first with ``page`` (from 0) and ``pages`` (of the query). ``at`` is a whole number.

    Places are taken in spans of ``span`` of a query's time and shifted by the counts of its later spans, so no task holds
    a query's hits whole; only the counts of a query meet, a row a span.
    """
    rows = hits.withColumn("_span", F.floor(F.col(at) / span))
    counts = rows.groupBy(query, "_span").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(query)
    later = F.sum("_n").over(whole.orderBy(F.desc("_span")).rowsBetween(Window.unboundedPreceding, -1))
    shifts = counts.select(F.col(query).alias("_query"), F.col("_span").alias("_of"), F.coalesce(later, F.lit(0)).alias("_later"), F.sum("_n").over(whole).alias("_all"))
    inner = F.row_number().over(Window.partitionBy(query, "_span").orderBy(F.desc(at), tie))
    placed = rows.join(shifts, F.col(query).eqNullSafe(F.col("_query")) & F.col("_span").eqNullSafe(F.col("_of"))).withColumn("_place", F.col("_later") + inner - 1)
    done = placed.withColumn("page", F.floor(F.col("_place") / size).cast("long")).withColumn("pages", F.ceil(F.col("_all") / size).cast("long"))
    return done.drop("_query", "_span", "_of", "_later", "_all", "_place")


def oldest_pages(hits: DataFrame, limit: int = PAGES) -> DataFrame:
    """Of a query with more pages than ``limit``, the oldest ones; ``capped`` says so."""
    return hits.filter(F.col("page") >= F.col("pages") - limit).withColumn("capped", F.col("pages") > limit)


def boundaries(read: DataFrame, query: str, at: str, since: Column, until: Column) -> DataFrame:
    """Per query how far it is covered and whether it is stalled.

    An uncapped query covers all of the window. A capped one may have been cut inside its newest second, so it covers
    up to the second newest distinct one it has read; where that is not beyond ``since`` it is stalled.
    """
    seconds = read.groupBy(query, at).agg(F.max("capped").alias("capped"))
    place = F.row_number().over(Window.partitionBy(query).orderBy(F.desc_nulls_last(at)))
    two = seconds.withColumn("_n", place).filter("_n <= 2")  # Spark takes two a partition before it shuffles
    per = two.groupBy(query).agg(F.max("capped").alias("capped"), F.max(F.when(F.col("_n") == 2, F.col(at))).alias("_second"))
    per = per.select(query, "capped", F.when(F.col("_second") > since, F.col("_second")).alias("_second"))
    safe = F.coalesce(F.col("_second"), since)
    return per.select(query, "capped", F.when(F.col("capped"), safe).otherwise(until).alias("boundary"), (F.col("capped") & (safe <= since)).alias("stalled"))


def unique_hits(hits: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Each hit once, from the first query that brought it."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return hits.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def hydrated(hits: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Hits with their items; a hit without one is a transient failure."""
    return hits.join(items, key, "left").withColumn("outcome", F.coalesce("outcome", F.lit("transient-failure")))


def confirmed(outcomes: DataFrame, bounds: DataFrame, at: str, since: Column, groups: list[str]) -> DataFrame:
    """Per read: the boundary that is confirmed, held back before the earliest transient failure, and why it is truncated.

    Filtered rows don't count. Malformed ones never move the boundary; half or more of what was read truncates it.
    """
    failed, malformed, read = (F.col("outcome") == x for x in ("transient-failure", "malformed", "document"))
    seen = outcomes.groupBy(*groups).agg(
        (F.min(F.when(failed, F.col(at))) - 1).alias("held"), F.count_if(malformed).alias("malformed"), F.count_if(read).alias("documents"))
    least = bounds.groupBy(*groups).agg(F.min("boundary").alias("boundary"), F.max("stalled").alias("stalled"))
    ratio = F.col("malformed") / (F.col("documents") + F.col("malformed"))
    short = F.coalesce((F.col("malformed") > 0) & (ratio >= MALFORMED_RATIO), F.lit(False))
    both = least.join(seen, groups, "left").withColumn("boundary", F.least("boundary", "held"))  # least skips nulls
    held = F.col("held").isNotNull() & (F.col("boundary") <= since)
    return both.select(*groups, "boundary", F.when(F.col("boundary") > since, F.col("boundary")).alias("cursor"), (F.col("stalled") | held | short).alias("truncated"))


def _with_stop(rows: DataFrame, groups: list[str], order: list[str], stop: Column) -> tuple[DataFrame, Column]:
    """``rows`` with ``_stop``, the place (by ``order``) of the first row of each feed where ``stop`` holds, and each row's place.

    The first place is a minimum with map-side parts, one row a feed, which is small enough to be sent to where the rows
    are; no feed is put in order.
    """
    place = F.struct(*order)
    first = rows.groupBy(*groups).agg(F.min(F.when(stop, place)).alias("_stop"))
    other = first.select(*[F.col(g).alias(f"_{k}") for k, g in enumerate(groups)], "_stop")
    same = F.lit(True)
    for k, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_{k}"))
    return rows.join(other, same).drop(*[f"_{k}" for k in range(len(groups))]), place


def until_mark(rows: DataFrame, groups: list[str], order: list[str], at: str, mark: Column) -> DataFrame:
    """The rows of each feed before the first that is at or before its mark; a feed without a mark is read whole."""
    known, place = _with_stop(rows, groups, order, F.coalesce(F.col(at) <= mark, F.lit(False)))
    return known.filter(F.col("_stop").isNull() | (place < F.col("_stop"))).drop("_stop")


def backfilled(rows: DataFrame, groups: list[str], order: list[str], at: str, since: Column, until: Column, resume: Column) -> DataFrame:
    """The rows of each feed down to the first before ``since``, without those at or before ``resume`` and those after ``until``."""
    known, place = _with_stop(rows, groups, order, F.col(at) < since)
    near = known.filter(F.col("_stop").isNull() | (place < F.col("_stop"))).drop("_stop")
    return near.filter((F.col(at) <= until) & F.coalesce(F.col(at) > resume, F.lit(True)))


def newest_seen(rows: DataFrame, groups: list[str], order: list[str], at: str, mark: Column) -> DataFrame:
    """Each feed's new mark: the newest of the rows walked, the one that stopped the walk included. It may lie before the old one."""
    known, place = _with_stop(rows, groups, order, F.coalesce(F.col(at) <= mark, F.lit(False)))
    return known.filter(F.col("_stop").isNull() | (place <= F.col("_stop"))).groupBy(*groups).agg(F.max(at).alias("mark"))


def passed_window(posts: DataFrame, page: str, at: str, since: Column) -> DataFrame:
    return posts.groupBy(page).agg(F.coalesce(F.bool_or(F.col(at) < since), F.lit(False)).alias("passed"))


def hit_ceiling(pages: DataFrame, groups: list[str]) -> DataFrame:
    """Feeds whose last allowed page still had rows and had not caught up."""
    return pages.filter((F.col("page") == FEED_PAGES) & (F.col("rows") > 0) & ~F.col("caught_up")).select(*groups)


def pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every row of one short list of settings with every row of another, in the order of the first (``ordinal``).

    Lists of more than ``PAIRED`` rows are no settings, and an error.
    """
    width = right.count()
    if max(width, left.count()) > PAIRED:
        raise ValueError(f"more than {PAIRED} settings to pair")
    a = left.withColumn("_i", F.row_number().over(Window.orderBy(*left.columns)) - 1)
    b = right.withColumn("_j", F.row_number().over(Window.orderBy(*right.columns)) - 1)
    return a.crossJoin(b).withColumn("ordinal", (F.col("_i") * width + F.col("_j")).cast("long")).drop("_i", "_j")


def next_places(read: DataFrame, pairs_: DataFrame) -> DataFrame:
    """Where a round over ``pairs_`` (ordinal and what it names) goes on after each page of ``read``.

    ``read`` has at (the pair's ordinal), given and after (places in it) and failed. A failed page is read again, a page
    with a next place goes on in its pair, else the next pair begins; after the last one the names and place are null.
    """
    stays = F.col("failed") | F.col("after").isNotNull()
    step = read.withColumn("ordinal", F.when(stays, F.col("at")).otherwise(F.col("at") + 1)).withColumn("_place", F.when(F.col("failed"), F.col("given")).otherwise(F.col("after")))
    joined = step.join(pairs_.withColumn("_known", F.lit(True)), "ordinal", "left")
    return joined.withColumn("place", F.when(F.col("_known"), F.col("_place"))).drop("_place", "_known", "ordinal")


def backfill_positions(cursors: DataFrame, cursor: str, places: DataFrame) -> DataFrame:
    """Where a backfill over ``places`` (ordinal, name) begins for each cursor: ``outcome``, ``ordinal`` and ``after``.

    start (no cursor) and restart (a name that is not there any more) begin at the first place; a cursor that is no object,
    has a listing, no name or a position of another type is malformed, and has no place. Names that are there twice are
    the first of them.
    """
    state = F.try_parse_json(cursor)
    held = cursors.withColumn("_state", state)
    at = F.col("_state")
    keys = F.map_keys(F.from_json(F.when(F.schema_of_variant(at).startswith("OBJECT"), F.col(cursor)), "map<string,variant>"))
    name, after = C.string_at(at, "$.subreddit"), C.string_at(at, "$.after")
    good = F.coalesce(name.isNotNull() & ~F.array_contains(keys, "listing") & C.kind_of(at, "$.after").isin("STRING", "VOID"), F.lit(False))
    told = held.withColumn("_good", good).withColumn("_name", F.when(good, name)).withColumn("_after", F.when(good, after))
    known = places.groupBy(F.col("name").alias("_name")).agg(F.min("ordinal").cast("long").alias("_known"))
    met = told.join(known, "_name", "left")
    outcome = F.when(F.col(cursor).isNull(), "start").when(~F.col("_good"), "malformed").when(F.col("_known").isNull(), "restart").otherwise("resume")
    placed = met.withColumn("outcome", outcome).withColumn("ordinal", F.when(F.col("outcome") == "resume", F.col("_known")).when(F.col("outcome") != "malformed", F.lit(0)))
    return placed.withColumn("after", F.when(F.col("outcome") == "resume", F.col("_after"))).drop("_state", "_good", "_name", "_after", "_known")
