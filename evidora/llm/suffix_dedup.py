"""Exact removal of long repeated strings by sharded suffix arrays.

Every string of ``length`` bytes (a window) has an anchor: the smallest hash of its ``GRAM``-byte substrings. Equal
windows have equal anchors, so windows need only meet the windows of their anchor. A run is a stretch of neighbouring
windows with one anchor in one place; its context is the bytes they cover. Equal windows never share a run.

1. One pass over the texts lists the runs: anchor, place, and a hash of the context. No text leaves the scan.
2. Anchors that occur once are dropped: their windows can't repeat. This is most of them.
3. Equal contexts (anchor and context hash, 128 bits) are counted and collapsed to their first and last occurrence. That
   the two are equal is a claim; claims that are neighbours in both documents are joined to stretches. Both sides of
   every stretch are read and compared byte by byte: what is equal is repeated.
4. One context each of the anchors that have several is read from its document and dealt to shards by anchor. Each
   shard builds its suffix array by induced sorting and the permuted common prefixes: a window is repeated where its
   suffix shares ``length`` bytes with a neighbour in the array. So every verdict compares bytes of two places; hashes
   bring windows together, and hand a verdict on to further copies of the same context.
5. The verdicts go back to the runs, are gathered by document, and the covered bytes are cut out.

A shard's size is bounded (small shards also keep the arrays in the processor's caches): shards are made as many as the
bytes need, a task works through several, a stretch ends at ``STRETCH`` bytes at the latest, and the windows of an anchor
with more than ``ANCHOR_CONTEXTS`` different contexts (a common line in very many documents) are claims of their own: a
128-bit hash of each window brings equal ones together, and they are compared as all claims are. Rows are named by 128
bits hashed from doc_id and text. Documents without anything to read are left out of steps 3 and 4 by a bit set that is
sized by their number (common.key_filter). Nothing about all documents goes to the driver but counts and this bit set. Both sides of each join on anchors are written tables, so that
the adaptive skew join can split a hot one.

Defined cases: a null text counts as empty; equal rows are copies of each other, so all their windows repeat; rows with a
null or repeated doc_id are told apart by their texts; texts of any length are read whole; texts shorter than ``length``
bytes stay as they are; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidora.llm.common import cut, fresh, hold, key_filter, spared, values
from evidora.llm.suffix_array import repeats

#: Production parameters.
LENGTH = 200
GRAM = 64
SHARD_BYTES, TASK_BYTES = 400_000, 8_000_000
STRETCH = 1 << 16
ANCHOR_CONTEXTS = 8192
_GROUP = 1 << 20
_KEY = ["k1", "k2"]
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each ``gram`` bytes (a power of two, 8 or more), by doubling."""
    h = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1)).copy().view("<u8").ravel() * _MIX
    size = 8
    while size < gram:
        h ^= h >> np.uint64(31)
        h = (h[:-size] * np.uint64(0xD6E8FEB86659FD93) + h[size:]) * _MIX
        size *= 2
    h ^= h >> np.uint64(29)
    return h


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (width - size)], h[width - size :]) if size < width else h


def runs(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """For the runs of all texts: text number, anchor, first window, windows; and the texts joined, and each one's start."""
    sizes = np.asarray([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    starts, joined = ends - sizes, b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    if len(data) < length:
        none = np.empty(0, np.int64)
        return none, none.view(np.uint64), none, none, joined, starts
    hashes = _gram_hashes(data, gram)
    anchor = _sliding_min(hashes, length - gram + 1)  # by window
    passed = (anchor[1:] != anchor[:-1]) | (hashes[: len(anchor) - 1] == anchor[:-1])  # the leftmost place of the anchor changes
    long = sizes >= length
    first = np.unique(np.concatenate([starts[long], np.flatnonzero(passed) + 1]))
    text = np.searchsorted(starts, first, "right") - 1
    # empty texts share their start with the next one; searchsorted takes the last of them, which is the one with bytes
    stop = np.minimum(np.append(first[1:], len(anchor)), ends[text] - length + 1)
    count = stop - first
    ok = count > 0
    first, text, count = first[ok], text[ok], count[ok]
    return text, anchor[first], first, count, joined, starts


def _grouped(batch_texts: Iterable[bytes | None], length: int):
    """Groups of about ``_GROUP`` bytes: numbers of the texts, offsets in them, and their bytes.

    A longer text comes in parts that overlap by all but one byte of a window, so each of its windows is in one part.
    """
    numbers, offsets, parts, size = [], [], [], 0
    for k, t in enumerate(batch_texts):
        for at in range(0, max(1, len(t or b"") - length + 1), _GROUP):
            numbers.append(k)
            offsets.append(at)
            parts.append((t or b"")[at : at + _GROUP + length - 1])
            size += len(parts[-1])
            if size >= _GROUP:
                yield np.asarray(numbers), np.asarray(offsets), parts
                numbers, offsets, parts, size = [], [], [], 0
    if parts:
        yield np.asarray(numbers), np.asarray(offsets), parts


def _key(doc: Column, data: Column) -> list[Column]:
    """128 bits that name a row by its doc_id and its bytes."""
    own = F.coalesce(doc.cast("long"), F.lit(0)), doc.isNull(), F.octet_length(data), data
    return [F.xxhash64(F.lit(seed), *own).alias(name) for seed, name in enumerate(_KEY, 1)]


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """k1 and k2 (the key of a row; equal rows have one), data (bytes) and doc_id."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(*_key(F.col("doc_id"), data), data.alias("data"), F.col("doc_id").cast("long").alias("doc_id"))


def _anchors(keyed: DataFrame, length: int) -> DataFrame:
    """The anchor of every run."""

    def run(batches):
        import pyarrow as pa

        hold("suffix")
        for batch in batches:
            for *_, group in _grouped(values(batch.column(0)), length):
                yield pa.RecordBatch.from_arrays([pa.array(runs(group, length)[1].view(np.int64))], ["anchor"])

    return keyed.select("data").mapInArrow(spared(run), "anchor long")


def _runs(keyed: DataFrame, length: int) -> DataFrame:
    """Every run: k1, k2, anchor, context (a hash), first and windows."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        hold("suffix")
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for numbers, offsets, group in _grouped(values(batch.column(2)), length):
                text, anchor, first, count, joined, starts = runs(group, length)
                view, of = memoryview(joined), xxhash.xxh3_64_intdigest
                context = [of(view[a:b]) for a, b in zip(first.tolist(), (first + count + length - 1).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(k1[numbers[text]]), pa.array(k2[numbers[text]]), pa.array(anchor.view(np.int64)),
                    pa.array(np.asarray(context, np.uint64).view(np.int64)), pa.array((first - starts[text] + offsets[text]).astype(np.int32)), pa.array(count.astype(np.int32)),
                ], [*_KEY, "anchor", "context", "first", "windows"])

    return keyed.select(*_KEY, "data").mapInArrow(spared(run), "k1 long, k2 long, anchor long, context long, first int, windows int")


def _cut_out(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` (k1, k2, first, windows and other columns) with the bytes that the windows cover instead of the place."""
    other = [c for c in wanted.columns if c not in (*_KEY, "first", "windows")]
    lists = wanted.groupBy(*_KEY).agg(F.collect_list(F.struct("first", "windows", *other)).alias("places"))  # of one document
    there = key_filter(wanted, "k1")
    texts = keyed.select(*_KEY, "data") if there is None else keyed.select(*_KEY, "data").filter(there("k1"))
    each = texts.dropDuplicates(_KEY).join(lists, _KEY).select("data", F.explode("places").alias("r"))
    return each.select(*[f"r.{c}" for c in other], F.substring("data", F.col("r.first") + 1, F.col("r.windows") + length - 1).alias("bytes"))


def _spans(hit: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"at": a, "n": b - a} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


def _stretches(claims: DataFrame) -> DataFrame:
    """The places to read for claims (x, y, lo, hi, windows): both sides of each stretch, one with the list of its claims.

    ``lo`` and ``hi`` are structs (k1, k2, first) of two places with the same ``windows`` windows. Columns: k1, k2, first,
    windows, s1 and s2 (which name the stretch), claims.
    """
    pair = Window.partitionBy("lo.k1", "lo.k2", "hi.k1", "hi.k2").orderBy("lo.first", "hi.first")
    before = F.lag(F.struct("lo", "hi", "windows")).over(pair)
    follows = (F.col("lo.first") == F.col("_p.lo.first") + F.col("_p.windows")) & (F.col("hi.first") == F.col("_p.hi.first") + F.col("_p.windows"))
    inside = F.floor(F.col("lo.first") / STRETCH) == F.floor(F.col("_p.lo.first") / STRETCH)
    number = F.sum(F.when(follows & inside, 0).otherwise(1)).over(pair)
    numbered = claims.withColumn("_p", before).withColumn("number", number)
    joined = numbered.groupBy("lo.k1", "lo.k2", F.col("hi.k1").alias("h1"), F.col("hi.k2").alias("h2"), "number").agg(
        F.min("lo.first").alias("first"), F.min("hi.first").alias("_first"), F.sum("windows").cast("int").alias("windows"),
        F.transform(F.sort_array(F.collect_list(F.struct(F.col("lo.first").alias("first"), "x", "y", "windows"))), lambda c: F.struct(c["x"].alias("x"), c["y"].alias("y"), c["windows"].alias("windows"))).alias("claims"))
    of = [F.xxhash64(F.lit(seed), "k1", "k2", "h1", "h2", "number").alias(name) for seed, name in enumerate(("s1", "s2"), 1)]
    lo = joined.select("k1", "k2", "first", "windows", *of, "claims")
    hi = joined.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.col("_first").alias("first"), "windows", *of, F.lit(None).alias("claims"))
    return lo.unionByName(hi)


def _solved(contexts: DataFrame, total: int, length: int) -> DataFrame:
    """anchor, context and spans: the repeated windows found by each shard's suffix array. ``total``: bytes of ``contexts``."""
    shards, tasks = (max(1, -(-total // size)) for size in (SHARD_BYTES, TASK_BYTES))
    dealt = contexts.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).repartition(tasks, "shard").sortWithinPartitions("shard")

    def run(batches):
        import pyarrow as pa

        hold("suffix")

        def solved(rows):
            marks = repeats([r[2] for r in rows], length)
            return _verdicts(((a, c, s) for (a, c, _), hit in zip(rows, marks, strict=True) if (s := _spans(hit))), ["anchor", "context", "spans"])

        shard, rows = None, []
        for batch in batches:
            for s, *row in zip(*(values(batch.column(n)) for n in ("shard", "anchor", "context", "bytes")), strict=True):
                if s != shard and rows:
                    yield solved(rows)
                    rows = []
                shard = s
                rows.append(row)
        if rows:
            yield solved(rows)

    return dealt.select("shard", "anchor", "context", "bytes").mapInArrow(spared(run), "anchor long, context long, spans array<struct<at:int,n:int>>")


def _verdicts(found, names: list[str]):
    """A record batch of two longs and spans."""
    import pyarrow as pa

    rows = list(found)
    of = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], of)], names)


def _equal(lo: bytes, hi: bytes, length: int) -> np.ndarray | None:
    """For each window whether its bytes are the same on both sides; None where all are."""
    if lo == hi:
        return None
    n = min(len(lo), len(hi))
    wrong = np.concatenate([[0], np.cumsum(np.frombuffer(lo[:n], np.uint8) != np.frombuffer(hi[:n], np.uint8))])
    hit = np.zeros(max(0, len(lo) - length + 1), bool)
    hit[: max(0, n - length + 1)] = wrong[length:] == wrong[: len(wrong) - length]
    return hit


def _window_claims(crowded: DataFrame, keyed: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """For contexts (k1, k2, anchor, context, first, windows): their windows (anchor, context, at, x, y), and claims on the
    first and the last place of each window hash that occurs twice or more."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        hold("suffix")
        of = xxhash.xxh3_128_digest
        for batch in batches:
            for *fields, data in zip(*(values(batch.column(n)) for n in ("k1", "k2", "anchor", "context", "start", "bytes")), strict=True):
                n = len(data) - length + 1
                digests = np.frombuffer(b"".join(of(data[k : k + length]) for k in range(n)), np.int64).reshape(-1, 2)
                at = np.arange(n, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([*(pa.array(np.full(n, f)) for f in fields[:4]), pa.array(at), pa.array(at + np.int32(fields[4])), pa.array(np.ascontiguousarray(digests[:, 0])),
                                                  pa.array(np.ascontiguousarray(digests[:, 1]))], ["k1", "k2", "anchor", "context", "at", "first", "x", "y"])

    named = crowded.select(*_KEY, "first", "windows", "anchor", "context", F.col("k1").alias("own1"), F.col("k2").alias("own2"), F.col("first").alias("start"))
    whole = _cut_out(keyed, named, length).select(F.col("own1").alias("k1"), F.col("own2").alias("k2"), "anchor", "context", "start", "bytes")
    windows = cut(whole.mapInArrow(spared(run), "k1 long, k2 long, anchor long, context long, at int, first int, x long, y long"))
    place = F.struct("k1", "k2", "first")
    claims = windows.groupBy("x", "y").agg(F.count("*").alias("n"), F.min(place).alias("lo"), F.max(place).alias("hi"), F.lit(1).alias("windows")).filter("n > 1")
    return windows, claims.select("x", "y", "lo", "hi", "windows")


def _proven(claims: DataFrame, keyed: DataFrame, length: int) -> DataFrame:
    """x, y and spans of the ``claims``: which of their windows have the same bytes on both sides."""
    sides = _cut_out(keyed, cut(_stretches(claims)), length).repartition("s1", "s2").sortWithinPartitions("s1", "s2", F.col("claims").isNull())

    def run(batches):
        hold("suffix")
        first = None
        for batch in batches:
            found = []
            for *own, said, data in zip(*(values(batch.column(n)) for n in ("s1", "s2", "claims", "bytes")), strict=True):
                if said is not None:
                    first = own, said, data
                elif first is not None and first[0] == own:
                    hit, at = _equal(first[2], data, length), 0
                    for c in first[1]:
                        n = c["windows"]
                        if spans := [{"at": 0, "n": n}] if hit is None else _spans(hit[at : at + n]):
                            found.append((c["x"], c["y"], spans))
                        at += n
            yield _verdicts(found, ["x", "y", "spans"])

    return sides.select("s1", "s2", "claims", "bytes").mapInArrow(spared(run), "x long, y long, spans array<struct<at:int,n:int>>")


def repeated(keyed: DataFrame, length: int) -> DataFrame:
    """k1, k2 and spans (first window, windows) of all repeated windows, a row for each document that has any."""
    common = cut(_anchors(keyed, length).groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"))
    met = cut(_runs(keyed, length).join(common, "anchor", "left_semi"))
    place = F.struct("k1", "k2", "first")
    distinct = cut(met.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(place).alias("lo"), F.max(place).alias("hi"), F.max("windows").alias("windows")))
    several = cut(distinct.groupBy("anchor").agg(F.count("*").alias("contexts")).filter("contexts > 1"))
    wanted = cut(distinct.join(several, "anchor").select("lo.*", "windows", "anchor", "context", (F.col("contexts") <= ANCHOR_CONTEXTS).alias("fits")))
    total, crowded = wanted.agg(F.sum(F.when(F.col("fits"), F.col("windows") + length)), F.count_if(~F.col("fits"))).first()
    claims = distinct.filter("n > 1").select(F.col("anchor").alias("x"), F.col("context").alias("y"), "lo", "hi", "windows")
    verdicts = cut(_proven(claims, keyed, length).toDF("anchor", "context", "spans"))
    once = distinct.filter("n = 1").select("anchor", "context")
    found = []
    if total:
        mixed = wanted.filter("fits").select(*_KEY, "first", "windows", "anchor", "context")
        found.append(_solved(_cut_out(keyed, mixed, length), total, length))
    if crowded:
        windows, own = _window_claims(wanted.filter("NOT fits").drop("fits"), keyed, length)
        hits = windows.join(cut(_proven(own, keyed, length)), ["x", "y"])
        found.append(hits.groupBy("anchor", "context").agg(F.collect_list(F.struct("at", F.lit(1).alias("n"))).alias("spans")))  # of one context
    for f in found:
        verdicts = verdicts.unionByName(f.join(once, ["anchor", "context"], "left_semi"))
    hits = met.join(cut(verdicts), ["anchor", "context"]).select(*_KEY, F.transform("spans", lambda s: F.struct((F.col("first") + s["at"]).alias("at"), s["n"].alias("n"))).alias("spans"))
    return hits.groupBy(*_KEY).agg(F.flatten(F.collect_list("spans")).alias("spans"))  # of one document


def _covered(spans: list[dict], length: int) -> list[tuple[int, int]]:
    """The maximal byte ranges that the windows of ``spans`` cover."""
    out: list[list[int]] = []
    for a, b in sorted((s["at"], s["at"] + s["n"] + length - 1) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _kept(data: bytes, ranges: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for r in ranges for x in r), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def digest(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row.

    Only the texts of documents that may lose something are joined to their spans; the others are digested where they
    are read.
    """
    keyed = _keyed(docs, text)
    lost = cut(repeated(keyed, length))
    there = key_filter(lost, "k1")

    def run(batches):
        import pyarrow as pa

        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        for batch in batches:
            rows = []
            for doc, data, spans in zip(*(values(batch.column(k)) for k in range(3)), strict=True):
                ranges = _covered(spans or [], length)
                rows.append((doc, len(data), sum(b - a for a, b in ranges), len(ranges), hashlib.sha256(_kept(data, ranges)).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    hit = F.lit(True) if there is None else there("k1")
    columns = F.col("doc_id"), F.col("data"), F.col("spans")
    whole = keyed.filter(~hit).select("doc_id", "data", F.lit(None).cast("array<struct<at:int,n:int>>").alias("spans"))
    open_ = keyed.filter(hit).join(lost, _KEY, "left").select(*columns)
    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return whole.mapInArrow(spared(run), fields).unionByName(open_.mapInArrow(spared(run), fields))


def remove(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """``docs`` without the repeated bytes; rows and other columns stay, a null text stays null.

    A cut may leave part of a character; the bytes of such parts go too, so that the text stays valid. Only documents
    that may lose something are joined to their spans.
    """
    lost = cut(repeated(_keyed(docs, text), length))
    there = key_filter(lost, "k1")
    names = [fresh(docs, "_k1"), fresh(docs, "_k2"), fresh(docs, "_spans")]
    own = _key(F.col("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary"))

    @F.pandas_udf("string")
    def cut_out(bodies, found):
        import pandas as pd

        return pd.Series([b if s is None or b is None else _kept(b.encode(), _covered(s, length)).decode(errors="ignore") for b, s in zip(bodies, found, strict=True)], dtype=object)

    hit = F.lit(True) if there is None else there(own[0])
    joined = docs.filter(hit).join(lost.toDF(*names), (own[0] == F.col(names[0])) & (own[1] == F.col(names[1])), "left")
    fixed = joined.withColumn(text, cut_out(F.col(text), F.col(names[2]))).select(*docs.columns)
    return docs.filter(~hit).unionByName(fixed)
