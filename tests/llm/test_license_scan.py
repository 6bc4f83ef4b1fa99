import random
import re

from evidora.llm import license_scan, queries


def shares(text, templates, wider):
    """For each licence the best containment over all places of the text; ``wider``: with a window's overlap."""
    words = [w.lower() for w in re.findall(r"[^\W_]+", text or "")]
    out = {}
    for name, bodies in templates.items():
        for body in [bodies] if isinstance(bodies, str) else bodies:
            want = [w.lower() for w in re.findall(r"[^\W_]+", body)]
            n = min(5, len(want))
            grams = {tuple(want[i : i + n]) for i in range(len(want) - n + 1)}
            place = [words[i : i + n] and tuple(words[i : i + n]) in grams for i in range(len(words))]
            best, length = 0.0, len(want) + (max(1, len(want) // 4) if wider else 0)
            for s in range(len(words)) if any(place) else ():
                part = words[s : s + length]
                best = max(best, len(grams & {tuple(part[i : i + n]) for i in range(len(part) - n + 1)}) / len(grams))
            if best >= 0.8:
                out[name] = max(best, out.get(name, 0))
    return out


def mutated(rng, body, k):
    words = body.split()
    for _ in range(k):
        words[rng.randrange(len(words))] = "other"
    return " ".join(words)


def test_against_brute_force(spark):
    rng = random.Random(2)
    fill = lambda n: " ".join(rng.choice(["the", "license", "under", "work", "free", "of", "été", "x1", "all", "rights"]) for _ in range(n))
    texts = [None, "", "license", "all rights", "ALL RIGHTS, reserved", fill(4000)]
    bodies = [(name, body) for name, own in license_scan.TEMPLATES.items() for body in own]
    for name, body in bodies[:: max(1, len(bodies) // 40)] + [(n, b[0]) for n, b in license_scan.TEMPLATES.items() if n in license_scan.NOTICES]:
        for k in (0, 1, 3):
            texts.append(f"{fill(rng.randint(0, 60))} {mutated(rng, body, k)}\n{fill(rng.randint(0, 30))}")
    texts.append(fill(3) + "".join(f" {x} {fill(5)}" for _, x in bodies))
    got: dict = {}
    for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, {})[r.license] = r.containment
    for i, text in enumerate(texts):
        least, most = (shares(text, license_scan.TEMPLATES, wider) for wider in (False, True))
        found = got.get(i, {})
        assert set(least) <= set(found) <= set(most), (i, text, least, found, most)
        assert all(least.get(name, 0.8) - 1e-9 <= share <= most[name] + 1e-9 for name, share in found.items())
    assert {r for own in got.values() for r in own} >= set(license_scan.NOTICES)


def test_lines_that_grant_a_licence(spark):
    lines = {"Released under the MIT License.": "MIT", "Licensed under the MIT License": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "available under the GNU Lesser General Public License, version 3": "LGPL-3.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "All rights reserved.": "all-rights-reserved", "no licence here": None}
    frame = spark.createDataFrame(list(enumerate(f"some words before {x} and after" for x in lines)), "doc_id long, text string")
    got = {r.doc_id: r.license for r in license_scan.scan(frame).collect()}
    assert [got.get(i) for i in range(len(lines))] == list(lines.values())


def test_rows_without_an_id(spark):
    """Rows with a null doc_id and windows at the same places: each has its own match."""
    notice = license_scan.NOTICES["MIT"]
    words = notice.split()
    rows = [(None, " ".join(words[: len(words) // 2])), (None, notice), (None, " ".join(words[len(words) // 2 :])), (3, notice), (3, notice + " end"), (3, notice)]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.license, r.containment) for r in got), key=str) == sorted([(None, "MIT", 1.0), (3, "MIT", 1.0), (3, "MIT", 1.0)], key=str)


def test_bands_alone_decide_on_candidates(spark, monkeypatch):
    """Without bands nothing is found: the verification is reached through them only."""
    monkeypatch.setattr(license_scan, "_minima", lambda hashes: license_scan.F.array().cast("array<bigint>"))
    assert license_scan.scan(spark.createDataFrame([(1, "All rights reserved")], "doc_id long, text string")).count() == 0


def test_query_and_odd_inputs(spark, odd, docs, empty, sf_dir):
    assert queries.op8_license_scan(spark, sf_dir).columns == ["doc_id", "license", "containment", "first_word"]
    assert license_scan.scan(empty).count() == 0
    own = {"passage": "a b c d e f", "one": "日本語"}
    frame = spark.createDataFrame([(1, "x a b c d e f y"), (1, "x a b c d e f y"), (2, "日本語 テ"), (None, "a b c d e f")], "doc_id long, text string")
    assert sorted(map(tuple, license_scan.scan(frame, own).collect()), key=str) == sorted([(1, "passage", 1.0, 0), (2, "one", 1.0, 0), (None, "passage", 1.0, 0)], key=str)
    assert license_scan.scan(frame, {}).count() == 0 == license_scan.scan(frame, {"blank": "..."}).count()
    assert license_scan.scan(odd).count() == license_scan.scan(docs).count()
