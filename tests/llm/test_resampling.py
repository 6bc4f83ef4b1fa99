import math
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from evidora.llm import queries, resampling

LABELS = "doc_id long, quality int, toxic int"


def test_models_and_scores_against_brute_force(spark, docs, rows):
    labels = [(i, int(i % 3 > 0), 0) for i in range(40)]
    target, raw = resampling.models(docs, spark.createDataFrame(labels, LABELS))
    found = {r[0]: resampling.features(r[1]).astype(int).tolist() for r in rows}
    want_t, want_r = np.zeros(resampling.BUCKETS), np.zeros(resampling.BUCKETS)
    for i, f in found.items():
        for b in f:
            want_r[b] += 1
            want_t[b] += i < 40 and i % 3 > 0
    assert (target == want_t).all() and (raw == want_r).all()
    ratio = [math.log((want_t[b] + 1) / (want_t + 1).sum()) - math.log((want_r[b] + 1) / (want_r + 1).sum()) for b in range(resampling.BUCKETS)]
    for r in resampling.score(docs, resampling.log_ratio(target, raw)).collect():
        f = found[r.doc_id]
        assert r.n_features == len(f) and abs(r.importance - sum(ratio[b] for b in f)) < 1e-6


def test_kth_largest(spark, monkeypatch):
    monkeypatch.setattr(resampling, "LAST", 5)
    monkeypatch.setattr(resampling, "BINS", 4)
    rng = random.Random(1)
    keys = [rng.gauss(0, 1) for _ in range(300)] + [0.25] * 40 + [1e6, -1e6]
    frame = spark.createDataFrame([(k,) for k in keys], "key double").cache()
    ordered = sorted(keys, reverse=True)
    for k in (1, 2, 100, 150, 342):
        assert abs(resampling.kth_largest(frame, k) - ordered[k - 1]) < 1e-9


def test_gumbel(spark):
    mean, spread = spark.range(20000).select(resampling.gumbel("id").alias("g")).agg(F.avg("g"), F.stddev("g")).first()
    assert abs(mean - 0.5772) < 0.05 and abs(spread - math.pi / 6**0.5) < 0.05


def brute_key(importance, doc_id, text):
    seed = xxhash.xxh64_intdigest((resampling.SEED).to_bytes(4, "little"), 42)
    mark = xxhash.xxh64_intdigest((text or "").encode(), 42)
    for part in ([doc_id] if doc_id is not None else []) + [mark]:
        seed = xxhash.xxh64_intdigest((part % 2**64).to_bytes(8, "little"), seed)
    return importance - math.log(-math.log(((seed >> 11) + 0.5) / 2**53))


def test_kept_against_brute_force(spark, docs, rows):
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(40)], LABELS)
    text = {r[0]: r[1] for r in rows}
    for keep in (None, 0.1, 0.5, 1.0):
        got = resampling.resample(docs, labels, keep).collect()
        keys = {r.doc_id: brute_key(r.importance, r.doc_id, text[r.doc_id]) for r in got}
        assert all(abs(keys[r.doc_id] - r.key) < 1e-6 for r in got)
        last = sorted(keys.values(), reverse=True)[round((0.75 if keep is None else keep) * len(rows)) - 1]
        assert {r.doc_id for r in got if r.kept} == {i for i, k in keys.items() if k >= last - 1e-9}


def test_no_good_label_and_no_id(spark):
    frame = spark.createDataFrame([(None if i % 2 else i, f"some text {i}") for i in range(10)], "doc_id long, text string")
    bad = resampling.resample(frame, spark.createDataFrame([(2, 0, 1)], LABELS)).collect()
    assert len(bad) == 10 and not any(r.kept for r in bad)
    none = resampling.resample(frame, spark.createDataFrame([], LABELS)).collect()
    assert all(r.kept for r in none) and len({r.key for r in none}) == 10


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").cache()
    got = {r.doc_id: r.kept for r in resampling.resample(docs, labels.filter("doc_id % 2 = 0")).collect()}
    assert len(got) == 1000
    held = [(got[r.doc_id], r.quality) for r in labels.filter("doc_id % 2 = 1").collect()]
    good, bad = [k for k, q in held if q == 1], [k for k, q in held if q == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_query_and_odd_inputs(spark, odd, docs, rows, empty, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (None, 1, 0), (5, None, None), (999, 1, 0), (7, 0, 1)], LABELS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op3_importance_resampling(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) >= round(0.8 * len(rows))
    nothing = spark.createDataFrame([], LABELS)
    assert resampling.resample(empty, nothing).count() == 0 and resampling.resample(empty, labels).count() == 0
    assert all(r.importance == 0 and r.kept for r in resampling.resample(docs, nothing).collect())
    twice = resampling.resample(odd, labels, 0.5).collect()
    assert len(twice) == 2 * len(rows) and sum(r.kept for r in twice) >= len(rows)
