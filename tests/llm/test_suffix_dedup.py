import hashlib
import random

import pytest

from evidora.llm import common, queries, suffix_dedup


def brute(texts, length):
    """Per text the covered ranges: bytes under a string of ``length`` bytes that starts anywhere else too."""
    seen: dict = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        cover = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                cover[i : i + length] = b"\x01" * length
        out.append(cover)
    return out


def summary(text, cover):
    spans = sum(c and (k == 0 or not cover[k - 1]) for k, c in enumerate(cover))
    return len(text), sum(cover), spans, hashlib.sha256(bytes(b for b, c in zip(text, cover, strict=True) if not c)).hexdigest()


def check(got, rows):
    texts = [(r[1] or "").encode() for r in rows]
    want = {r[0]: summary(t, c) for r, t, c in zip(rows, texts, brute(texts, 200), strict=True)}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    return want


def hard(rng):
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(60) for _ in range(4)]
    exact200 = prose(60).encode()[:200].decode(errors="ignore")
    texts = [None, "", "x", "a" * 199, "a" * 200, "ab" * 300, "z" * 9000, prose(3000)]
    texts += [prose(rng.randint(1, 80)) + rng.choice(passages)[rng.randint(0, 40) :] + prose(rng.randint(0, 50)) for _ in range(60)]
    base = prose(150)
    texts += [base[: k * 9] + word() + base[k * 9 + 3 :] for k in range(40)] + [base] * 5 + [prose(40)] * 3
    texts += ["1" + exact200 + "2", "3" + exact200 + "4", "5" + exact200[:-1] + "6", passages[0] + passages[0]]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("limits", [{}, {"ANCHOR_CONTEXTS": 3, "SHARD_BYTES": 3000, "STRETCH": 500, "_GROUP": 2000}, {"common.FILTER_MOST": 1}, {"common.FILTER_BITS": 60_000}])
def test_against_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(common if name.startswith("common.") else suffix_dedup, name.removeprefix("common."), value)
    rows = hard(random.Random(9))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = check(suffix_dedup.digest(frame).collect(), rows)
    assert sum(n > 0 for _, n, *_ in want.values()) > 50


def test_query(spark, rows, sf_dir):
    check(queries.op1_suffix_array(spark, sf_dir).collect(), rows)


def test_odd_inputs(spark, odd, docs, rows, empty):
    assert suffix_dedup.digest(empty).count() == 0 and suffix_dedup.remove(empty).count() == 0
    twice = suffix_dedup.digest(odd).collect()
    assert len(twice) == 2 * len(rows) and all(r.n_removed == (r.n_bytes if r.n_bytes >= 200 else 0) for r in twice)
    left = suffix_dedup.remove(odd)
    assert left.columns == odd.columns and left.count() == 2 * len(rows)
    plain = {r.doc_id: r.text for r in suffix_dedup.remove(docs).collect()}
    kept = {r.doc_id: r.kept_sha256 for r in suffix_dedup.digest(docs).collect()}
    for doc_id, text, *_ in rows:
        if text is None:
            assert plain[doc_id] is None
        elif text.isascii():
            assert hashlib.sha256(plain[doc_id].encode()).hexdigest() == kept[doc_id]
    nulls = spark.createDataFrame([(None, "q" * 300), (None, "w" * 10), (None, None)], "doc_id long, text string")
    assert sorted(r.n_removed for r in suffix_dedup.digest(nulls).collect()) == [0, 0, 300]


def test_rows_without_an_id_are_told_apart(spark):
    """Thousands of them, some of whose texts have equal 32-bit hashes: only what repeats is removed."""
    from pyspark.sql import functions as F

    made = spark.range(120_000).select(F.col("id"), F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2(F.concat(F.col("id").cast("string"), F.lit("x")), 512)).alias("text"))
    clash = made.groupBy(F.hash(F.col("text").cast("binary")).alias("h")).agg(F.collect_list("id").alias("ids")).filter(F.size("ids") > 1).select(F.explode("ids").alias("id"))
    pairs = [r.text for r in made.join(clash, "id").collect()]
    assert len(pairs) >= 2
    rows = [(None, t) for t in pairs] + [(None, pairs[0])]
    got = suffix_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.n_removed for r in got) == [0] * (len(pairs) - 1) + [256, 256]


def test_a_wrong_claim_is_not_believed(spark, monkeypatch):
    """Contexts whose hashes clash: the suffix array sees that their bytes differ."""
    from pyspark.sql import functions as F

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcde") for _ in range(9))
    same = " ".join(word() for _ in range(12))
    rows = [(i, " ".join(word() for _ in range(15)) + same + " ".join(word() for _ in range(15))) for i in range(6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    plain = suffix_dedup._runs
    monkeypatch.setattr(suffix_dedup, "_runs", lambda *args: plain(*args).withColumn("context", F.lit(0).cast("long")))
    assert all(r.n_removed == 0 for r in suffix_dedup.digest(frame).collect())
