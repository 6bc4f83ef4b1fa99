import corpus_pipeline
from pyspark.sql import functions as F

from tests_llm_brute import jaccard_components, quality_kept, without_repeats


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages_against_brute_force(spark, docs, rows, sf_dir):
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality", "near_duplicates", "repeats", "secrets", "packing"]
    first = steps["quality"](spark, docs, sf_dir)
    assert first.columns == docs.columns and texts(first) == {i: t for i, t, *_ in rows if quality_kept(t)}
    second = steps["near_duplicates"](spark, docs, sf_dir)
    groups = jaccard_components({r[0]: r[1] for r in rows}, 5, 0.8)
    assert {r[0] for r in rows} - set(texts(second)) == {i for i, root in groups.items() if i != root}
    third = steps["repeats"](spark, docs, sf_dir)
    want = without_repeats({r[0]: r[1] for r in rows}, 200)
    assert texts(third) == want
    assert all(r.n_chars == len(r.text) for r in third.collect() if r.text is not None)
    secret = docs.withColumn("text", F.concat(F.lit("token = abcdef123 "), "text"))
    assert all(t is None or t.startswith("[SECRET]") for t in texts(steps["secrets"](spark, secret, sf_dir)).values())


def test_recall_of_near_duplicates(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    whole = {r.doc_id: r.text for r in docs.collect()}
    groups = jaccard_components(whole, 5, 0.8)
    kept = set(texts(corpus_pipeline.near_duplicates(spark, docs, "")))
    due = {i for i, root in groups.items() if i != root}
    assert len(due) > 50 and set(whole) - kept == due


def test_run(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert got and {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(got[0].asDict())
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)


def test_odd_inputs(spark, odd, empty, sf_dir):
    for frame in (empty, odd):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, sf_dir)
            out.count()
            assert name == "packing" or set(out.columns) == set(frame.columns)
