import re
from collections import Counter

import pytest

from evidora.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_counts_and_base_verdict(spark, rows, sf_dir):
    got = {r.doc_id: r for r in queries.op9_quality_rules(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        want, r = brute(text), got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, doc_id
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def brute_hosts(data):
    """The hosts that are rejected, rule by rule, in plain Python."""
    def verdicts(text):
        words, chars, symbols, dup, repeat = brute(text)
        lines = sum(bool(WORD.search(x)) for x in (text or "").split("\n"))
        return words < 50, 100 * repeat > 50 * words, 100 * symbols > 10 * chars, 100 * dup > 30 * lines

    by: dict = {}
    for _, text, host in data:
        by.setdefault(host, []).append(verdicts(text))
    out = set()
    for rule in range(4):
        f = {h: sum(v[rule] for v in x) for h, x in by.items()}
        rate = [f[h] / len(by[h]) for h in by]
        m, mean = sum(f.values()) / len(data), sum(rate) / len(rate)
        v = sum((x - mean) ** 2 for x in rate) / len(rate)
        k = max(1.0, min(1000.0, m * (1 - m) / v - 1)) if v else 1000.0
        for h in by:
            p = (f[h] + m * k) / (len(by[h]) + k)
            if p - 2 * (p * (1 - p) / (len(by[h]) + k + 1)) ** 0.5 >= min(0.8, max(0.3, 3 * m)):
                out.add(h)
    return out


def test_bad_hosts_are_rejected(spark):
    """A host with many bad documents goes by each of the rules; one with few rows, or no worse than the corpus, stays."""
    good, bad = " ".join(f"w{i}" for i in range(60)), "short"
    marks, lines = " ".join(f"w{i} ###" for i in range(60)), "\n".join(["one line again"] + ["a line of its own %d and more words in it %d" % (i, i) for i in range(5)] * 2)
    data = [(i, good if i % 20 else bad, f"clean{i % 9}") for i in range(2000)]
    for host, text, share in (("junk", bad, 0.5), ("marks", marks, 0.45), ("lines", lines, 0.6), ("rather", bad, 0.15)):
        data += [(5000 + len(data), text if i < share * 200 else good, host) for i in range(200)]
    data += [(9000, bad, "tiny"), (9001, good, "tiny"), (9002, good, None)]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string")
    judged = quality.judge(frame).collect()
    kept = {r.doc_id for r in judged if r.kept}
    rejected = brute_hosts(data)
    assert rejected == {"junk", "marks", "lines"}
    fails = lambda t: brute(t)[0] < 50 or 2 * brute(t)[4] > brute(t)[0]
    assert kept == {i for i, t, s in data if not fails(t) and s not in rejected}
    assert {r.doc_id for r in quality.keep(frame).collect()} == kept
    rate = {r.source: r.host_rate for r in judged}
    assert rate["junk"] > 1 > rate["rather"] > rate["clean1"]


def test_planted_bad_host_in_the_test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    plain = quality.keep(docs).count()
    assert quality.judge(docs).filter("kept").count() == plain == quality.judge(docs).filter("NOT base_failed").count()  # no host is worse than others
    planted = spark.range(60).selectExpr("100000 + id AS doc_id", "CASE WHEN id % 2 = 0 THEN 'x y z' ELSE repeat(concat('word', CAST(id AS STRING), ' and a few more words of its own '), 1) END AS text", "'bad' AS source")
    longer = docs.filter("doc_id < 400 AND length(text) > 1000").selectExpr("200000 + doc_id AS doc_id", "text", "'bad' AS source").limit(30)
    both = docs.unionByName(planted).unionByName(longer)
    kept = {r.doc_id for r in quality.keep(both).collect()}
    assert len(kept) == plain and max(kept) < 100_000


def test_odd_inputs(odd, docs, empty):
    assert quality.judge(empty).count() == 0 and quality.keep(empty).count() == 0
    assert quality.judge(odd).count() == 2 * docs.count()
    assert quality.keep(odd).columns == odd.columns


@pytest.mark.parametrize("text, want", [("a b c a b c", 6), ("a b c x a b c d", 6), ("a a a a", 4), ("a b", 0)])
def test_repeats(spark, text, want):
    assert quality.measures(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")).first().n_repeat_words == want
