"""Connected components of a graph held as a table of edges, by alternating large and small stars.

Every round moves each node's larger neighbours to its smallest one (large star), then each node and its smaller
neighbours to the smallest of them (small star); the edges end as stars around each component's smallest node, after a
number of rounds that grows with the logarithm of the longest chain. Minima are taken by map-side aggregation, and the
joins are ordinary ones on written tables, so the adaptive skew join can split a node with very many neighbours. The
driver sees one count and one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidora.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) for every node of ``edges`` (long a and b) but the roots.

    Loops, repeated and reversed edges do no harm; edges with a null end are left out; no edges give no rows.
    """
    pair = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = cut(pair.filter("a > b").distinct())
    state = _state(now)
    while state[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = cut(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m")))
        larger = now.select(F.col("b").alias("u"), F.col("a").alias("v"))  # the edges to larger neighbours
        large = cut(larger.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        first = cut(large.groupBy("a").agg(F.min("b").alias("m")))
        moved = large.join(first, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(moved.union(first.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
