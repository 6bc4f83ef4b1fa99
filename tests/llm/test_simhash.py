import random
import re

import numpy as np
import xxhash

from evidora.llm import components, queries, simhash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [words[i : i + 4] for i in range(len(words) - 3)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    """nodes: keys; linked(a, b) -> bool; the smallest key reachable from each."""
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b) and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {x: find(x) for x in nodes}


def test_query(spark, rows, sf_dir):
    got = {r.doc_id: r for r in queries.op2_simhash(spark, sf_dir).collect()}
    marks = {doc_id: brute_fingerprint(text) for doc_id, text, *_ in rows}
    want = brute_components(sorted(marks), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 4)
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{marks[i]:016x}", want[i]) for i in marks}
    assert len(set(want.values())) < len(want)


def near_sets(rng, centres, each, flips):
    out = set()
    for _ in range(centres):
        x = rng.getrandbits(64)
        for _ in range(each):
            y = x
            for _ in range(rng.randint(0, flips)):
                y ^= 1 << rng.randrange(64)
            out.add(y)
    return sorted(out)


def test_trie_join_in_groups():
    rng = random.Random(1)
    for each, flips in ((3, 5), (40, 4), (400, 6)):
        values = near_sets(rng, 5, each, flips)
        groups = np.sort(np.asarray([rng.randrange(3) for _ in values]))
        pairs = sorted(zip(groups.tolist(), values, strict=False))
        labels = simhash.trie_join(np.asarray([g for g, _ in pairs]), np.asarray([v for _, v in pairs], np.uint64))
        want = brute_components(pairs, lambda a, b: a[0] == b[0] and (a[1] ^ b[1]).bit_count() <= 4)
        assert [pairs[k] for k in labels] == [want[p] for p in pairs]


def test_links_over_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 20)  # splits buckets again, down to the last depth
    rng = random.Random(2)
    values = near_sets(rng, 6, 150, 3) + [0, 1, 2**63, 2**64 - 1]
    values = sorted(set(values))
    frame = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for v in values], "fp long")
    got = {r.node: r.root for r in components.components(simhash.links(frame)).collect()}
    sets: dict = {}
    for v in values:
        s = v - 2**64 if v >> 63 else v
        sets.setdefault(got.get(s, s), set()).add(v)
    want: dict = {}
    for v, r in brute_components(values, lambda a, b: (a ^ b).bit_count() <= 4).items():
        want.setdefault(r, set()).add(v)
    assert sorted(map(sorted, sets.values())) == sorted(map(sorted, want.values()))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000 + i, 1000) for i in range(50)] + [(1000, 1049), (7, 7), (None, 3), (2000, 2001), (2001, 2000)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 101)}, **{1000 + i: 1000 for i in range(1, 50)}, 2001: 2000}


def test_pairs_of_nodes_are_pruned():
    rng = np.random.default_rng(9)
    values = np.sort(rng.integers(0, 2**63, 4000, dtype=np.int64).astype(np.uint64))
    pruned: list[int] = []
    labels = simhash.trie_join(np.zeros(len(values), np.int64), values, 4, pruned)
    assert (labels == np.arange(len(values))).all()
    pairs = len(values) * (len(values) - 1) // 2
    assert 0.4 * pairs < sum(pruned) < pairs and max(pruned) > 16  # whole branches go at once


def jaccard(a, b):
    def grams(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_verified_groups(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts = [None, "", " ", "one", "one"]
    for _ in range(25):
        base = [word() for _ in range(200)]
        texts.append(" ".join(base))
        for k in (1, 2, 3, 30):
            copy = list(base)
            for i in rng.sample(range(200), k):
                copy[i] = word()
            texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.verified(frame, 5, 0.8, 7).collect()}
    want = brute_components(list(range(len(texts))), lambda a, b: jaccard(texts[a], texts[b]) >= 0.8)
    assert got == want


def test_odd_inputs(odd, docs, rows, empty):
    assert simhash.group(empty).count() == 0 and simhash.verified(empty, 5, 0.8, 7).count() == 0
    assert simhash.group(odd).count() == 2 * len(rows) == simhash.verified(odd, 5, 0.8, 7).count()
    grouped = simhash.group(docs)
    kept = simhash.keep(odd, grouped)
    assert kept.columns == odd.columns
    ids = {r.doc_id for r in grouped.collect() if r.doc_id == r.component_id}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(list(ids) * 2)


def test_copies_behind_the_head_of_their_fingerprint(spark):
    rng = random.Random(6)
    base = [f"{rng.getrandbits(40):x}" for _ in range(200)]
    mixed, swapped = rng.sample(base, 200), [*base[:50], base[51], base[50], *base[52:]]
    rows = list(enumerate([mixed, base, swapped]))
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.verified(frame, 5, 0.8, 8).collect()} == {0: 0, 1: 1, 2: 1}


def test_added_and_removed_passages(spark):
    rng = random.Random(7)
    word = lambda: f"{rng.getrandbits(40):x}"
    texts = []
    for n in (60, 120, 300):
        for _ in range(8):
            base, more = [word() for _ in range(n)], [word() for _ in range(n // 5 - 2)]
            texts += [base, base + more, base[: n - n // 6]]
    texts = [" ".join(t) for t in texts]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.verified(frame, 5, 0.8, 8).collect()}
    want = brute_components(list(range(len(texts))), lambda a, b: jaccard(texts[a], texts[b]) >= 0.8)
    assert got == want and sum(want[i] != i for i in want) == 48


def test_few_different_words(spark):
    """Pairs of texts over forty words with three words changed, whose fingerprints tell little."""
    rng = random.Random(10)
    words = [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([60, 150, 400]))]
        copy = list(base)
        for i in rng.sample(range(len(base)), 3):
            copy[i] = rng.choice(words)
        texts += [" ".join(base), " ".join(copy)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.verified(frame, 5, 0.8, 8).collect()}
    want = brute_components(list(range(len(texts))), lambda a, b: jaccard(texts[a], texts[b]) >= 0.8)
    assert got == want and sum(want[i] != i for i in want) >= 20


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """Copies with up to six words changed, with and without the original there: neither all linked nor all apart."""
    rng = random.Random(11)
    word = lambda: f"{rng.getrandbits(40):x}"
    base = [word() for _ in range(150)]
    texts = []
    for k in range(160):
        copy = list(base)
        for i in rng.sample(range(150), k % 7 + (k < 150)):
            copy[i] = word()
        texts.append(" ".join(copy) + (" more" * (k % 3)))
    made = []
    plain = simhash._unlinked
    monkeypatch.setattr(simhash, "_unlinked", lambda *args: made.append(plain(*args)) or made[-1])
    for own in (texts, texts[:150]):
        want = brute_components(list(range(len(own))), lambda a, b: jaccard(own[a], own[b]) >= 0.8)
        frame = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")
        assert {r.doc_id: r.component_id for r in simhash.verified(frame, 5, 0.8, 8).collect()} == want
    assert made[0].count() < 30 * 160  # of 12720 pairs


def test_a_shared_token_travels_once(spark):
    """A passage in every text: its tokens are credited where they are read, in one task and across tasks."""
    rng = random.Random(12)
    shared = " ".join(f"{rng.getrandbits(40):x}" for _ in range(90))
    texts = [shared + f" {rng.getrandbits(40):x}" for _ in range(60)] + [" ".join(f"{rng.getrandbits(40):x}" for _ in range(60)) for _ in range(20)]
    frame = spark.createDataFrame([(" ".join([t]),) for t in texts], "text string")
    for parts in (1, 7):
        found = simhash._partnered(frame.repartition(parts), 10_000, 5, 0.8, "text").count()
        assert 60 <= found < 80


def test_documents_without_an_id(spark):
    rng = random.Random(8)
    alone, twice, named, base = ([f"{rng.getrandbits(40):x}" for _ in range(100)] for _ in range(4))
    near = lambda t: [*t[:-1], "end"]
    mixed, swapped = rng.sample(base, 100), [*base[:50], base[51], base[50], *base[52:]]
    rows = [(None, alone), (None, twice), (None, twice), (None, near(twice)), (5, named), (None, near(named)), (None, mixed), (7, base), (8, swapped)]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    kept = simhash.keep(frame, simhash.verified(frame, 5, 0.8, 8))
    assert kept.columns == frame.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(i for i, _ in got if i is not None) == [5, 7]
    lone = sorted(t for i, t in got if i is None)
    assert len(lone) == 3 and {" ".join(alone), " ".join(mixed)} < set(lone)
