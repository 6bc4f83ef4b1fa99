"""Mergeable cluster statistics against the exact ones."""

from pyspark.sql import functions as F

from evidora.operators import sketches

SCHEMA = "c string, r int, d string, s string, i double"


def sketched(evidence):
    return sketches.sketched(evidence, "c", "r", "d", "s", "i")


def test_small_clusters_are_exact_and_nulls_defined(spark):
    rows = [("a", 1, "1", "x", 1.0), ("a", 1, "1", "y", 3.0), ("a", 2, "2", "x", 2.0), ("a", 2, None, None, None), ("b", 2, "1", "x", None), (None, 1, "9", "x", 1.0), ("b", None, "9", "x", 1.0)]
    made = {r.cluster: r for r in sketches.statistics(sketches.over_runs(sketched(spark.createDataFrame(rows, SCHEMA)))).collect()}
    assert set(made) == {"a", "b"}
    assert (made["a"].run, made["a"].mentions, made["a"].documents, made["a"].sources, made["a"].median, made["a"].high) == (2, 4, 2, 2, 2.0, 3.0)
    assert (made["b"].mentions, made["b"].documents, made["b"].median) == (1, 1, None)
    assert sketches.statistics(sketches.over_runs(sketched(spark.createDataFrame([], SCHEMA)))).count() == 0


def test_large_clusters_are_within_the_stated_error_and_replays_change_nothing(spark):
    n = 200_000
    rows = spark.range(n).select(F.when(F.col("id") % 3 == 0, "small").otherwise("hot").alias("c"), (F.col("id") % 4).cast("int").alias("r"), F.xxhash64("id").cast("string").alias("d"),
                                 F.concat(F.lit("s"), F.col("id") % 7).alias("s"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_003)) / 1_000_003).alias("i"))
    fresh = [sketched(rows.filter(F.col("r") == r)) for r in range(4)]
    state = fresh[0]
    for run in (fresh[1], fresh[1], fresh[2], fresh[0], fresh[3], fresh[3]):
        state = sketches.taken_in(state, run)
    made = {r.cluster: r for r in sketches.statistics(state).collect()}
    whole = {r.cluster: r for r in sketches.statistics(sketches.over_runs(sketched(rows))).collect()}
    for name, row in made.items():
        own = rows.filter(F.col("c") == name)
        count = own.count()
        assert row.mentions == whole[name].mentions == count and row.sources == 7 and row.run == 3
        assert abs(row.documents - count) < 4 * count / 2 ** (sketches.LOG_ENTRIES / 2)
        for value, rank in ((row.median, 0.5), (row.high, 0.9)):
            assert abs(own.filter(F.col("i") <= value).count() / count - rank) < 3 * 2.3 / sketches.K ** 0.9
