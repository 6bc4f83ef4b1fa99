import zlib
from collections import Counter, defaultdict

import xxhash

from evidora.llm import queries, sharding


def test_every_row_once_and_even(spark, rows, sf_dir):
    got = queries.op6_stratified_sharding(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    sizes, slots = Counter(r.shard for r in got), defaultdict(list)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(8))
    text = {r[0]: (r[1] or "").encode() for r in rows}
    for r in got:
        slots[r.shard].append(r.slot)
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text[r.doc_id]) + 1, zlib.crc32(text[r.doc_id]), "rows", None)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def unit(*parts):
    seed = xxhash.xxh64_intdigest(sharding.SEED.to_bytes(4, "little"), 42)
    for x in parts:
        if x is not None:
            seed = xxhash.xxh64_intdigest(x.encode() if isinstance(x, str) else (x % 2**64).to_bytes(8, "little"), seed)
    return (seed >> 11) / 2**53


def brute(data, shards):
    """(doc_id, crc32) -> (shard, slot) by the whole order: ranks in each source by seeded hash, then fractional ranks."""
    rows, own = [], defaultdict(list)
    for doc_id, text, source in data:
        crc = zlib.crc32((text or "").encode())
        own["0" if source is None else "1" + source].append((unit(doc_id, crc), doc_id, crc))
    for stratum, found in own.items():
        for rank, (key, doc_id, crc) in enumerate(sorted(found), 1):
            rows.append(((rank - unit(stratum)) / len(found), stratum, key, doc_id, crc))
    out, total = {}, len(rows)
    for place, (*_, doc_id, crc) in enumerate(sorted(rows)):
        shard = place * shards // total
        out[doc_id, crc] = (shard, place - -(-shard * total // shards))
    return out


def test_against_brute_force(spark, rows, docs, sf_dir, monkeypatch):
    got = {(r.doc_id, r.text_crc32): (r.shard, r.slot) for r in queries.op6_stratified_sharding(spark, sf_dir).collect()}
    assert got == brute([(i, t, s) for i, t, _, s, _ in rows], 8)
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 40)  # many buckets, the same order
    data = [(i, f"text {i % 50}", None if i % 5 == 0 else "hot" if i % 3 == 0 else f"s{i % 11}") for i in range(1500)]
    found = sharding.shard(spark.createDataFrame(data, "doc_id long, text string, source string"), shards=7).collect()
    assert {(r.doc_id, r.text_crc32): (r.shard, r.slot) for r in found} == brute(data, 7)


def test_mixture(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 50)  # many buckets
    data = [(i, f"t{i}", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(3000)]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = sharding.shard(frame).collect()
    assert len(got) == 3000 and len({(r.shard, r.slot) for r in got}) == 3000
    source = {i: s for i, _, s in data}
    share = Counter((source[r.doc_id], r.shard) for r in got)
    for s in ("hot", "s1", "s2"):
        n = [share[s, k] for k in range(8)]
        assert max(n) - min(n) <= 3, (s, n)
    again = sharding.shard(frame.repartition(7)).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in got} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_many_sources_of_one_row(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 50)
    data = [(i, "t", "hot" if i % 3 == 0 else f"one{i}") for i in range(3000)]
    got = sharding.shard(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()
    n = Counter(r.shard for r in got if r.doc_id % 3 == 0)
    assert max(abs(x - 125) for x in n.values()) <= 4 * (2000 / 12) ** 0.5  # 4 standard deviations


def test_odd_inputs(odd, docs, empty):
    assert sharding.shard(empty).count() == 0
    got = sharding.shard(odd).collect()
    assert len(got) == 2 * docs.count() and len({(r.shard, r.slot) for r in got}) == len(got)
