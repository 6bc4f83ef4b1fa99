import hashlib
import math
import random
import time

import pytest
import regex
from pyspark.sql import functions as F

from evidora.llm import pii, queries

SCHEMA = "doc_id long, text string"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = sum(int(c) for c in digits[::-2])
    return (total + sum(sum(map(int, str(2 * int(c)))) for c in digits[-2::-2])) % 10 == 0


def card(rng, length=16):
    body = "".join(rng.choice("0123456789") for _ in range(length - 1))
    return next(body + c for c in "0123456789" if luhn(body + c))


def brute_base(text):
    only = lambda m: [c for c in m if c.isdigit()]
    fine = [lambda m: True, lambda m: all(int(p) <= 255 for p in m.split(".")), lambda m: 16 <= len(only(m)) <= 19 and luhn("".join(only(m))), lambda m: 8 <= len(only(m)) <= 15]
    return [(k, m.start(), m.end()) for k, (p, ok) in enumerate(zip((EMAIL, IP, CARD, PHONE), fine, strict=True)) for m in regex.finditer(p, text or "") if ok(m[0])]


def said(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans)


def noise(rng):
    parts = ["a@b.c", "@", ".", "..", "-", "_", "+1", "+", " ", "  ", "(0)", "12", "1.2.3.4", "256.1.1.1", "007.0.00255.1", "é", "😀", "x", "%", "\n", "1234 5678-9012", "+49 (30) 555-123", card(rng), card(rng, 19), "9" * 25]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))


def test_base_spans_on_random_strings(spark):
    rng = random.Random(1)
    texts = [noise(rng) for _ in range(4000)] + [None, "", "a@b.c_d@e.f", "a@b.c..d@e.f", "1.2.3.4.5.6.7.8", "+1+12345678", "+1 (017) 555-7713"]
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    body = F.coalesce("text", F.lit(""))
    for r in frame.select("text", pii.written(pii.base_spans(body)).alias("s")).collect():
        assert r.s == said(brute_base(r.text)), repr(r.text)


def named(seed=4):
    """Texts in which one name stands beside one mailbox, a common word beside another, and copies beside a third."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit", "ame", "con") for b in ("em", "um", "or", "et", "ct")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [prose(rng.randint(5, 60)) for _ in range(300)]
    texts += [f"{prose(30)} write to Zbigniew{'!' * (k % 2)} at z.k@mail.example.org {prose(20)}" for k in range(6)]
    texts += [f"{prose(30)} lorem {rng.choice(words)} info@example.org {prose(20)}" for k in range(6)]
    texts += [f"{prose(20)} Hapaxes only here: once@example.org ok"] * 3
    same = "Quixotry same@example.org passage of all"
    texts += [f"{prose(30)} {' ' * 90} {same} {' ' * 90} {prose(20)}" for _ in range(5)]
    texts += ["Nobody but zbigniew knows.", "ZBIGNIEW, zbigniew2 and xzbigniew", None, ""]
    return list(enumerate(texts))


def brute_shares(rows):
    texts = sorted({t or "" for _, t in rows})
    terms = lambda t: {w for w in regex.findall(r"[\p{L}\p{M}\p{N}]{3,}", regex.sub(EMAIL, " ", t).lower()) if regex.search(r"\p{L}", w)}
    entity, near = {}, {}
    for t in texts:
        for kind, pattern in enumerate((EMAIL, IP, CARD, PHONE)):
            found = list(regex.finditer(pattern, t))
            good = {(s, e) for k, s, e in brute_base(t) if k == kind}
            for k, m in enumerate(found):
                if m.span() not in good:
                    continue
                left = t[found[k - 1].end() if k else 0 : m.start()]
                right = t[m.end() : found[k + 1].start() if k + 1 < len(found) else len(t)]
                left = regex.sub(r"^[\p{L}\p{M}\p{N}]+", "", left[-pii.CONTEXT :]) if len(left) > pii.CONTEXT else left
                right = regex.sub(r"[\p{L}\p{M}\p{N}]+$", "", right[: pii.CONTEXT]) if len(right) > pii.CONTEXT else right
                name = f"{kind}:{m[0].lower() if kind == 0 else m[0] if kind == 1 else regex.sub('[^0-9]', '', m[0])}"
                context = f"{left} | {right}"
                entity.setdefault(name, set()).add(t)
                for w in terms(context):
                    near.setdefault((name, w), set()).add((t, context))
    out = {}
    for (name, w), where in near.items():
        c, n = len({t for t, _ in where}), len(texts)
        if min(c, len({x for _, x in where})) >= pii.MIN_CONTEXTS and len(entity[name]) < n:
            df = sum(w in terms(t) for t in texts)
            out[name, w] = math.log(n * c / (len(entity[name]) * df)) / math.log(n / len(entity[name]))
    return out


def test_shares_same_as_brute_force(spark):
    rows = named()
    got = {(r.entity, r.term): r.share for r in pii.disclosures(spark.createDataFrame(rows, SCHEMA).repartition(4), least=-9.0).collect()}
    want = brute_shares(rows)
    assert got.keys() == want.keys() and len(want) > 5
    assert all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)
    strong = {k for k, v in want.items() if v >= pii.GENERALISE}
    assert ("0:z.k@mail.example.org", "zbigniew") in strong and {e for e, _ in strong} == {"0:z.k@mail.example.org"}


def test_scan_adds_disclosing_terms(spark):
    rows = named()
    strong = {w for (_, w), v in brute_shares(rows).items() if v >= pii.GENERALISE - 1e-12}
    assert "zbigniew" in strong and not strong & {"hapaxes", "quixotry", "lorem"}
    for r in pii.scan(spark.createDataFrame(rows, SCHEMA).repartition(4), keys=("doc_id", "text")).collect():
        text = r.text or ""
        base = brute_base(text)
        masked = text
        for p in (EMAIL, IP, CARD, PHONE):
            masked = regex.sub(p, lambda m: " " * len(m[0]), masked)
        added = [(4, m.start(), m.end()) for m in regex.finditer(r"[\p{L}\p{M}\p{N}]{3,}", masked) if m[0].lower() in strong]
        assert [tuple(s) for s in r.base] == base
        assert [tuple(s) for s in r.spans] == base + added


def test_sanitised_texts(spark):
    rows = named() + [(900, "mail A@b.co, ip 10.0.0.1; tel +49 (30) 555-12345."), (901, "4111 1111 1111 1111 and +4111111111111111"), (902, "plain é 😀")]
    fixed = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert fixed[900] == "mail [EMAIL], ip [IP]; tel [PHONE]."
    assert fixed[901] == "[CARD] and +[CARD]"
    assert fixed[902] == "plain é 😀"
    of = dict(rows)
    assert [k for k in of if of[k] is None] == [k for k in fixed if fixed[k] is None]
    told = " ".join(t or "" for t in fixed.values())
    assert "@example" not in told and "Zbigniew" not in told and "Quixotry" in told and "xzbigniew" in told


@pytest.mark.parametrize("broadcast", [0, 200_000])
def test_joins_give_the_same(spark, monkeypatch, broadcast):
    monkeypatch.setattr(pii, "BROADCAST_TERMS", broadcast)
    rows = named(5)
    got = {(r.entity, r.term): round(r.share, 9) for r in pii.disclosures(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {k: round(v, 9) for k, v in brute_shares(rows).items() if v >= pii.GENERALISE - 1e-12}


def test_long_texts_take_linear_time(spark):
    long = ["x" * 400_000, "1" * 400_000, "a@" * 100_000, "b." * 150_000, "a@" + "b." * 150_000 + "c", "1.2." * 60_000, "+1(" * 60_000, "+1" + "(" * 200_000, "user@mail.example.com 1.2.3.4 " * 4_000]
    began = time.time()
    frame = spark.createDataFrame(list(enumerate(long)), SCHEMA)
    got = {r.doc_id: r.n for r in pii.scan(frame).select("doc_id", F.size("base").alias("n")).collect()}
    assert got == dict(enumerate([0, 0, 0, 0, 1, 30_000, 0, 0, 8_000]))
    assert time.time() - began < 60


def test_query_and_odd_rows(spark, docs, odd, empty, sf_dir):
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    got = queries.op12_pii(spark, sf_dir)
    assert got.columns == names
    for r in got.join(docs, "doc_id").collect():
        base = brute_base(r.text)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == b[0] for b in base) for k in range(4))
        assert r.base_sha256 == digest(said(base)) and r.spans.startswith(said(base))
    assert pii.scan(empty).collect() == [] and pii.sanitise(empty).collect() == []
    twice = pii.scan(odd).select("doc_id", pii.written(F.col("spans")).alias("s")).collect()
    assert len(twice) == 2 * docs.count() and len(set(twice)) == docs.count()
    assert pii.sanitise(odd).columns == odd.columns and pii.sanitise(odd).count() == odd.count()
