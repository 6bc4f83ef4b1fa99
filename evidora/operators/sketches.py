"""Cluster statistics that merge: each run sketches its own evidence once, and clusters take runs in without reading old ones.

A sketch row has the cluster, ``run`` and ``mentions`` (exact), a theta sketch of documents and one of sources (exact below
``2 ** LOG_ENTRIES`` of them, then about ``1 / sqrt(2 ** LOG_ENTRIES)`` off) and a KLL sketch of intensities (all of them
below ``K``, then about ``2.3 / K ** 0.9`` of the ranks off). Sizes are bounded by these numbers, whatever a cluster holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_ENTRIES, K = 12, 1024


def sketched(evidence: DataFrame, cluster: str, run: str, document: str, source: str, intensity: str) -> DataFrame:
    """One row a cluster and run, by sums with map-side parts, so a hot cluster is no hot task.

    Evidence without a cluster or run is left out; null documents, sources and intensities count as mentions only.
    """
    known = evidence.filter(F.col(cluster).isNotNull() & F.col(run).isNotNull())
    return known.groupBy(F.col(cluster).alias("cluster"), F.col(run).alias("run")).agg(
        F.count("*").alias("mentions"), F.theta_sketch_agg(document, LOG_ENTRIES).alias("documents"), F.theta_sketch_agg(source, LOG_ENTRIES).alias("sources"),
        F.kll_sketch_agg_double(F.col(intensity).cast("double"), K).alias("intensities"))


def over_runs(sketches: DataFrame) -> DataFrame:
    """One row a cluster from any number of its runs; ``run`` is the newest. A run that is there twice counts twice."""
    return sketches.groupBy("cluster").agg(
        F.max("run").alias("run"), F.sum("mentions").alias("mentions"), F.theta_union_agg("documents", LOG_ENTRIES).alias("documents"),
        F.theta_union_agg("sources", LOG_ENTRIES).alias("sources"), F.kll_merge_agg_double("intensities", K).alias("intensities"))


def taken_in(state: DataFrame, fresh: DataFrame) -> DataFrame:
    """``state`` (a row a cluster) after the runs in ``fresh``: only runs newer than the cluster's last one, so a replay changes nothing.

    What is read is a row a cluster and a row a fresh run, never evidence.
    """
    last = state.select("cluster", F.col("run").alias("_last"))
    newer = fresh.join(last, "cluster", "left").filter(F.col("_last").isNull() | (F.col("run") > F.col("_last"))).drop("_last")
    return over_runs(state.unionByName(newer))


def estimate(sketch: str) -> Column:
    return F.theta_sketch_estimate(sketch)


def quantile(sketch: str, rank: float) -> Column:
    """The intensity at ``rank``; null where the cluster has none."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(rank)))


def statistics(state: DataFrame) -> DataFrame:
    """By cluster: mentions, documents, sources, and the intensity's median and 90th percentile."""
    return state.select("cluster", "run", "mentions", estimate("documents").alias("documents"), estimate("sources").alias("sources"),
                        quantile("intensities", 0.5).alias("median"), quantile("intensities", 0.9).alias("high"))
