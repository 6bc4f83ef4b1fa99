"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash inside each source and ranked; a row's fractional rank (rank - phase) / n, with a
phase in [0, 1) hashed from the source, spreads each source evenly over (0, 1]. Sorting all rows by it interleaves the
sources in proportion, so every cut of the order has the mixture of the whole. Cutting at equal counts gives shards
whose sizes differ by one row at most. A source's rows in two shards differ by two or three where the sources are few;
the random phases of s sources shift each cut by about the square root of s / 12 rows, shared out over all sources.

Both ranks are taken without gathering a source or the order in one task: rows are dealt into buckets of a uniform
value (the hash, then the fractional rank), buckets are counted with map-side sums, and a row's rank is its bucket's
offset plus its rank inside the bucket. A source with a third of all rows is spread over as many buckets as its rows
need; the random phase keeps the many sources of one row from meeting at one fractional rank.

Defined cases: a null text counts as empty (size 1, crc32 0); a null source is a source of its own; null or repeated
doc_ids are rows like others, ordered by their text's crc32; equal rows may swap places; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidora.llm.common import cut

#: Production parameters.
SHARDS = 8
SEED = 20240131
#: Rows of one source that a ranking task takes, on average.
BUCKET_ROWS = 16384


def _unit(*cols: Column | str) -> Column:
    """A uniform value in [0, 1) hashed from ``cols``."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *cols), 11) / float(1 << 53)


def _ranked(rows: DataFrame, groups: list[str], bucket: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: the rank from 1 by ``order`` in each of ``groups``; ``bucket`` ascends with the order."""
    counts = rows.groupBy(*groups, bucket).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy(*groups)
    offsets = counts.select(*groups, bucket, F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias(f"{name}_of"))
    inner = F.row_number().over(Window.partitionBy(*groups, bucket).orderBy(*order))
    return (rows.withColumn("_inner", inner).join(offsets, [*groups, bucket])
            .withColumn(name, F.col("_before") + F.col("_inner")).drop("_inner", "_before"))


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard) for every row of ``docs``."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    stratum = F.when(F.col(source).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(source)))
    slim = docs.select("doc_id", stratum.alias("_stratum"), (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    slim = cut(slim.withColumn("_key", _unit(F.col("doc_id"), F.col("text_crc32"))))
    total = slim.count()
    buckets = float(2 ** max(0, math.ceil(math.log2(max(1, total) / BUCKET_ROWS))))
    by_hash = slim.withColumn("_bucket", F.floor(F.col("_key") * buckets))
    ranked = _ranked(by_hash, ["_stratum"], "_bucket", ["_key", "doc_id", "text_crc32"], "_rank").drop("_bucket")
    fraction = (F.col("_rank") - _unit(F.col("_stratum"))) / F.col("_rank_of")
    placed = cut(ranked.withColumn("_fraction", fraction).withColumn("_slice", F.floor(F.col("_fraction") * buckets)).drop("_rank", "_rank_of"))
    order = _ranked(placed.withColumn("_all", F.lit(0)), ["_all"], "_slice", ["_fraction", "_stratum", "_key", "doc_id"], "_place")
    place = F.col("_place") - 1
    number = F.expr(f"((_place - 1) * {shards}) div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return order.withColumn("shard", number.cast("int")).select("doc_id", "size", "text_crc32", "shard", (place - first).alias("slot"))
