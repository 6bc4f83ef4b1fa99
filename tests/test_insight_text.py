import math
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from evidora.operators import insight


def test_citations_in_one_pass(spark, monkeypatch):
    docs = [(1, "the cat sat on the mat"), (2, None), (3, ""), (4, "Über 😀 naïve aaaa")]
    spans = [("a", 1, "cat sat"), ("a", 1, "sat on"), ("b", 1, "dog"), ("b", 1, "the"), ("c", 2, "x"), ("d", 3, ""), ("e", 4, "😀 na"), ("e", 4, "aa"), ("e", 4, "aaa"), ("f", 4, None), ("g", 9, "x"), ("h", None, "x"), ("a", 1, "cat sat")]
    d, s = spark.createDataFrame(docs, "id long, body string"), spark.createDataFrame(spans, "brief string, document_id long, span string")
    of = dict(docs)
    want: dict = {}
    for brief, doc, span in spans:
        there = span is not None and of.get(doc) is not None and span in of[doc]
        ok, missing = want.get(brief, (True, 0))
        want[brief] = ok and there, missing + (not there)
    for most in (10_000, 1):
        monkeypatch.setattr(insight, "SPANS", most)
        assert {r.brief: (r.intact, r.missing) for r in insight.citations(s, d).collect()} == want
    assert insight.citations(s.filter("false"), d).collect() == []


def test_time_is_flat_in_the_number_of_spans(spark):
    body = " ".join(f"w{k}" for k in range(100_000))
    d = spark.createDataFrame([(1, body)], "id long, body string")
    few, many = (spark.range(n).select(F.lit(1).cast("long").alias("document_id"), F.concat(F.lit(" w"), F.col("id") * 3 + 3, F.lit(" w")).alias("span")).cache() for n in (50, 5000))
    took = []
    for s in (few, few, many):
        s.count()
        began = time.time()
        assert insight.quoted(s, d).count() == s.count()
        took.append(time.time() - began)
    assert took[2] < 5 * took[1] + 2  # a hundred times the spans


def test_bm25_same_as_brute_force(spark):
    docs = [(1, "red Cat cat dog"), (2, "a dog; a Dog, a dog!"), (3, None), (4, ""), (5, "über cat é1 red red"), (6, "nothing here")]
    seeds = [(1, "cat red cat"), (2, "DOG über"), (3, None), (4, "absent")]
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    own = {i: Counter(words(t)) for i, t in docs}
    mean = sum(sum(c.values()) for c in own.values()) / len(docs)

    def score(c, seed):
        out = 0.0
        for t in set(words(seed)):
            n = sum(t in x for x in own.values())
            if c[t]:
                out += math.log(1 + (len(docs) - n + 0.5) / (n + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean))
        return out

    got = {r.id: r.score for r in insight.lexical_scores(spark.createDataFrame(docs, "id long, body string"), spark.createDataFrame(seeds, "id long, body string")).collect()}
    assert got.keys() == own.keys() and all(abs(got[i] - max(score(c, s) for _, s in seeds)) < 1e-9 for i, c in own.items())


def test_bm25_shuffles_no_document(spark):
    d = spark.range(300).select("id", F.concat(F.lit("w"), (F.col("id") % 7).cast("string"), F.lit(" red")).alias("body"))
    scored = insight.lexical_scores(d, d.filter("id < 5"))
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    assert scored.filter("score > 0").count() == 300
    assert {r.score for r in insight.lexical_scores(d, d.filter("false")).collect()} == {0.0} and insight.lexical_scores(d.filter("false"), d).collect() == []
