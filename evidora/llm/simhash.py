"""SimHash near-duplicates by a binary trie self-join.

A fingerprint bit is the majority of that bit over the 64-bit hashes of a text's word shingles. Equal fingerprints are
collapsed first. Two fingerprints within ``distance`` bits agree wholly on one of ``distance + 1`` blocks of bits, so
each fingerprint goes to one bucket a block, and buckets that hold too many are split again by blocks of the bits that
are still free, which loses no pair; what is too large after ``DEPTH`` splits is dealt out in pairs of parts. In a bucket
the fingerprints, sorted, are the leaves of a binary trie whose nodes are ranges. Pairs of nodes go down together, bit by
bit; a pair that has taken different branches more than ``distance`` times is pruned, and so is a pair that lies in one
component already. Only pairs of nodes with ``_LEAF`` pairs of fingerprints at most are compared by all their bits at
once. A bucket returns edges that span its components, one fewer than their nodes, never all pairs; the graph of these
edges is resolved across buckets.

Defined cases: a null text counts as empty; a text without words has the fingerprint zero and is linked like others;
rows with equal doc_id count as one document in ``keep``; a null doc_id is ignored where the smallest is taken; texts of
any length are read whole; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidora.llm.common import cut, fresh, hold, key_filter, spared
from evidora.llm.common import values as each_value
from evidora.llm.components import components

#: Production parameters. SHINGLE and DISTANCE are those of the query; the pipeline stage has its own in corpus_pipeline.
SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Fingerprints in a bucket beyond which it is split again, and how often that may happen.
BUCKET, DEPTH = 8192, 3
#: The part of the shingle hashes that is counted over all texts before any are compared, and the slices it travels in.
LOW, SLICE_TOKENS = 0.375, 1 << 20
#: Sizes of sets within a factor of this share a class.
CLASS = 1.05
_LEAF, _SLICE, _FLUSH = 4, 1 << 19, 1 << 15
_SHARED = -0x61C8864680B583EB  # stands for the texts of a token that one task has seen in several


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> list[int]:
    """Hashes of the shingles of the lower-cased text; of the whole sequence where it is shorter than a shingle."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return []
    body, of = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [of(body, SEED)]
    starts = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()
    return [of(body[a : b - 1], SEED) for a, b in zip(starts, starts[shingle:], strict=False)]


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """A fingerprint for each array of hashes; zero for none."""
    sizes = np.asarray([len(h) for h in hashes])
    out = np.zeros(len(hashes), np.uint64)
    there = np.flatnonzero(sizes)
    if len(there):
        bits = np.unpackbits(np.concatenate([hashes[i] for i in there]).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.concatenate([[0], np.cumsum(sizes[there])[:-1]])
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        out[there] = np.packbits(2 * ones > sizes[there][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", distinct: bool = False) -> DataFrame:
    """doc_id, ``body`` (a hash of the text), the fingerprint as a long, of ``distinct`` shingles or of all, and their number; one pass, no shuffle."""

    def run(batches):
        import pyarrow as pa

        hold("simhash")
        for batch in batches:
            done, counts, group, size = [], [], [], 0
            for body in each_value(batch.column(2)):
                hashes = np.asarray(shingle_hashes(body, shingle), np.uint64)
                group.append(np.unique(hashes) if distinct else hashes)
                counts.append(len(hashes))
                size += len(group[-1])
                if size > 1 << 18:
                    done.append(majority(group))
                    group, size = [], 0
            done.append(majority(group))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(done).view(np.int64)), pa.array(counts, pa.int64())], ["doc_id", "body", "fp", "count"])

    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(whole, F.length(whole)), whole).mapInArrow(spared(run), "doc_id long, body long, fp long, count long")


def _join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Lowers ``labels`` until each edge's ends have the same one; labels stay indices of their components' smallest."""
    while len(a):
        x, y = labels[a], labels[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            lower = labels[labels]
            if (lower == labels).all():
                break
            labels[:] = lower


def trie_join(groups: np.ndarray, values: np.ndarray, distance: int = DISTANCE, pruned: list[int] | None = None) -> np.ndarray:
    """For rows sorted by (group, value), each row's smallest row linked within its group through ``distance`` bits or fewer.

    ``pruned`` gets the number of pairs of fingerprints below each pair of nodes that is left out for its differing bits.
    """
    n = len(values)
    labels = np.arange(n)
    if n < 2:
        return labels
    edges = np.flatnonzero(np.diff(groups)) + 1
    lo, hi = np.concatenate([[0], edges]), np.concatenate([edges, [n]])
    many = hi - lo > 1
    lo, hi = lo[many], hi[many]
    stack = [(0, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    ones: dict[int, np.ndarray] = {}
    while stack:
        depth, ulo, uhi, vlo, vhi, err = stack.pop()
        change = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])])
        joined = (labels[ulo] == labels[vlo]) & (change[uhi - 1] == change[ulo]) & (change[vhi - 1] == change[vlo])
        work = (uhi - ulo) * (vhi - vlo)
        leaf = ~joined & ((work <= _LEAF) | (depth == 64))
        if leaf.any():
            at = np.flatnonzero(leaf)
            for part in np.split(at, np.searchsorted(np.cumsum(work[at]), np.arange(_SLICE, int(work[at].sum()), _SLICE))):
                if len(part):
                    pair = np.repeat(part, work[part])
                    k = np.arange(len(pair)) - np.repeat(np.cumsum(work[part]) - work[part], work[part])
                    wide = (vhi - vlo)[pair]
                    a, b = ulo[pair] + k // wide, vlo[pair] + k % wide
                    bits = np.bitwise_count(values[a] ^ values[b])
                    near = (bits <= distance) & (a < b)
                    _join_labels(labels, a[near], b[near])
        rest = np.flatnonzero(~joined & ~leaf)
        if not len(rest):
            continue
        if len(rest) > _FLUSH:  # depth first: a bounded part of the front at a time
            for part in np.array_split(rest, -(-len(rest) // _FLUSH)):
                stack.append((depth, ulo[part], uhi[part], vlo[part], vhi[part], err[part]))
            continue
        ulo, uhi, vlo, vhi, err = (x[rest] for x in (ulo, uhi, vlo, vhi, err))
        if depth not in ones:
            ones[depth] = np.concatenate([[0], np.cumsum((values >> np.uint64(63 - depth)) & np.uint64(1))]).astype(np.int64)
        sums = ones[depth]
        umid, vmid = uhi - (sums[uhi] - sums[ulo]), vhi - (sums[vhi] - sums[vlo])
        same = ulo == vlo
        children = [(ulo, umid, vlo, vmid, err, None), (umid, uhi, vmid, vhi, err, None), (ulo, umid, vmid, vhi, err + 1, None), (umid, uhi, vlo, vmid, err + 1, ~same)]
        kept = []
        for cul, cuh, cvl, cvh, ce, only in children:
            ok = (cul < cuh) & (cvl < cvh) & ~((cul == cvl) & (cuh - cul == 1))
            if only is not None:
                ok &= only
            if pruned is not None:
                far = ok & (ce > distance)
                pruned.extend(((cuh - cul) * (cvh - cvl))[far].tolist())
            ok &= ce <= distance
            kept.append([x[ok] for x in (cul, cuh, cvl, cvh, ce)])
        stack.append((depth + 1, *(np.concatenate(x) for x in zip(*kept, strict=True))))
    return labels


def _blocks(mask: int, count: int) -> list[int]:
    """The free bits of ``mask`` in ``count`` runs; each result also has the bits of ``mask``."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << int(b) for b in part) for part in np.array_split(free, count) if len(part)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucketed(distinct: DataFrame, distance: int) -> DataFrame:
    """fp, mask, part (the masked bits) and cell: every pair within ``distance`` meets in one (mask, part, cell) at least."""
    rows, masks = distinct.select("fp", F.lit(0).cast("long").alias("mask")), [0]
    done = None
    for depth in range(DEPTH):
        # a constant of (distance + 1) ** (depth + 1) masks at most: the blocks of each mask of this depth
        finer = {m: _blocks(m, distance + 1) for m in masks}
        masks = [b for blocks in finer.values() for b in blocks]
        table = F.create_map(*[x for m, blocks in finer.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(b)) for b in blocks]))])
        split = rows.select("fp", F.explode(F.element_at(table, F.col("mask"))).alias("mask")).withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))
        crowded = cut(split.groupBy("mask", "part").agg(F.count("*").alias("_n")).filter(F.col("_n") > BUCKET))
        calm = split.join(crowded, ["mask", "part"], "left_anti").withColumn("cell", F.lit(0).cast("long"))
        done = calm if done is None else done.unionByName(calm)
        if crowded.isEmpty():
            break
        rows = split.join(crowded.drop("_n"), ["mask", "part"], "left_semi").select("fp", "mask")
        if depth == DEPTH - 1:  # what is still large: each of its parts meets each other one in a cell of its own
            parts = F.ceil(F.col("_n") / BUCKET)
            own = split.join(crowded, ["mask", "part"]).withColumn("_parts", parts).withColumn("_own", F.pmod(F.xxhash64("fp"), F.col("_parts")))
            met = own.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
            done = done.unionByName(met.select("fp", "mask", "part", (F.least("_own", "_other") * F.col("_parts") + F.greatest("_own", "_other")).alias("cell")))
    return done


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) over the distinct ``fp`` that connect exactly those that a chain of near fingerprints connects."""
    keys = ["mask", "part", "cell"]
    dealt = _bucketed(distinct, distance).repartition(*keys).sortWithinPartitions(*keys, "fp")

    def run(batches):
        import pyarrow as pa

        hold("simhash")

        def flushed(*held):
            fp = held[-1]
            new = np.concatenate([[True], np.any([np.diff(k) != 0 for k in held[:-1]], axis=0)])
            group, value = np.cumsum(new), fp.view(np.uint64)
            order = np.lexsort((value, group))
            group, value = group[order], value[order]
            label = trie_join(group, value, distance)
            a = np.flatnonzero(label != np.arange(len(label)))
            return pa.RecordBatch.from_arrays([pa.array(value[a].view(np.int64)), pa.array(value[label[a]].view(np.int64))], ["a", "b"])

        held = [np.empty(0, np.int64)] * 4
        for batch in batches:
            held = [np.concatenate([h, batch.column(k).to_numpy()]) for k, h in enumerate(held)]
            if len(held[0]) >= _FLUSH:  # up to the last bucket, which may go on in the next batch
                end = np.flatnonzero(np.any([k != k[-1] for k in held[:-1]], axis=0))
                if len(end):
                    stop = end[-1] + 1
                    yield flushed(*(h[:stop] for h in held))
                    held = [h[stop:] for h in held]
        if len(held[0]):
            yield flushed(*held)

    return dealt.select(*keys, "fp").mapInArrow(spared(run), "a long, b long")


def _named(distinct: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """``key`` and component_id for the rows of ``distinct`` (key, first), joined by ``edges`` over keys."""
    roots = cut(components(edges))
    rooted = distinct.join(roots, F.col(key) == F.col("node"), "left").select(key, "first", F.coalesce("root", key).alias("root"))
    rooted = cut(rooted)
    least = cut(rooted.groupBy("root").agg(F.min("first").alias("component_id")))  # both sides of the join are written: a large component's task can be split
    return cut(rooted.join(least, "root").select(key, "component_id"))


def group(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, text: str = "text") -> DataFrame:
    """doc_id, fp (long) and component_id (the smallest doc_id reachable) for every row."""
    marked = cut(fingerprints(docs, shingle, text).drop("body", "count"))
    distinct = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    return marked.join(_named(distinct, links(distinct, distance), "fp"), "fp").select("doc_id", "fp", "component_id")


def _texts(docs: DataFrame, text: str) -> DataFrame:
    """body and whole (the text, empty for null) of every row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.xxhash64(whole, F.length(whole)).alias("body"), whole.alias("whole"))


def _set(text: str, shingle: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted; the one member 0 for a text without words."""
    return np.unique(np.asarray(shingle_hashes(text, shingle) or [0], np.uint64))


def _spare(size, similarity: float):
    """How many members of a set of ``size`` another set may lack at most, if the two reach ``similarity``."""
    return size - np.ceil(similarity * size - 1e-9).astype(np.int64)


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int, text: str) -> DataFrame:
    """body and set (the distinct hashes of its shingles) of the texts in ``wanted`` (body); copies go before the shuffle."""

    def run(batches):
        import pyarrow as pa

        hold("simhash")
        for batch in batches:
            sets = [_set(x, shingle).view(np.int64) for x in each_value(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["body", "set"])

    there, texts = key_filter(wanted, "body"), _texts(docs, text)
    few = texts if there is None else texts.filter(there("body"))
    return few.dropDuplicates(["body"]).join(wanted, "body", "left_semi").mapInArrow(spared(run), "body long, set array<long>")


def _partnered(docs: DataFrame, tokens: int, shingle: int, similarity: float, text: str) -> DataFrame:
    """The bodies of the texts that may have a partner of ``similarity``; none that has one is left out.

    Of the shingles, those in the lower ``LOW`` of the hash range are counted over all texts. A partner has all but
    _spare(n) of a text's n shingles, so a text with more than that many that no other text has is out. Tokens travel
    packed, as 32 bits of their hashes, by as many slices of the hash range as ``tokens`` (about how many there are) need, and each text's need by
    slices of the bodies. A token that a task meets in several texts is credited to them there and travels once, so a
    passage that very many texts share gathers in no slice.
    """
    slices = max(64, int(tokens * LOW) // SLICE_TOKENS)

    def pack(batches):
        import pyarrow as pa

        hold("simhash")

        def packed(first, keys, values, at):
            order = np.argsort(at, kind="stable")
            at = at[order]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1, [len(at)]])
            keys, values = keys[order], values[order]
            spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
            return pa.RecordBatch.from_arrays([pa.array(at[cuts[:-1]].astype(np.int64) + first), pa.array([keys[x:y].tobytes() for x, y in spans], pa.binary()), pa.array([values[x:y].tobytes() for x, y in spans], pa.binary())], ["slice", "keys", "values"])

        def flushed(low, own, need):
            bodies, needs = np.asarray(own, np.int64), np.asarray(need, np.int64)
            yield packed(slices, bodies, needs, bodies.view(np.uint64) % np.uint64(slices))
            hashes = np.concatenate(low)
            if not len(hashes):
                return
            texts = np.repeat(np.arange(len(bodies)), [len(x) for x in low])
            found, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
            several = counts[inverse] > 1
            credit = np.bincount(texts[several], minlength=len(bodies))
            some = np.flatnonzero(credit)
            if len(some):
                yield packed(2 * slices, bodies[some], credit[some].astype(np.int64), bodies[some].view(np.uint64) % np.uint64(slices))
            common = found[counts > 1]
            keys = np.concatenate([hashes[~several], common])
            values = np.concatenate([bodies[texts[~several]], np.full(len(common), _SHARED)])
            yield packed(0, keys.astype(np.uint32), values, keys // np.uint64(int(LOW * 2**64) // slices + 1))  # clashes only let more texts pass

        low, own, need, seen, size = [], [], [], set(), 0
        for batch in batches:
            for body, whole in zip(batch.column(0).to_pylist(), each_value(batch.column(1)), strict=True):
                if body in seen:
                    continue
                seen.add(body)
                found = _set(whole, shingle)
                part = found[: np.searchsorted(found, np.uint64(int(LOW * 2**64)))].copy()
                low.append(part)
                own.append(body)
                need.append(len(part) - int(_spare(len(found), similarity)))
                size += len(part) + 16
                if size > 1 << 20:
                    yield from flushed(low, own, need)
                    low, own, need, seen, size = [], [], [], set(), 0
        if own:
            yield from flushed(low, own, need)

    def count(table):
        import pyarrow as pa

        kind = table.column("slice")[0].as_py() // slices
        keys, values = (np.frombuffer(b"".join(table.column(k).to_pylist()), of) for k, of in (("keys", np.int64 if kind else np.uint32), ("values", np.int64)))
        if kind == 2:  # credits
            return pa.table({"body": keys, "n": values})
        order = np.lexsort((values, keys))
        keys, values = keys[order], values[order]
        once = np.concatenate([[True], (np.diff(keys) != 0) | (np.diff(values) != 0)])  # copies
        keys, values = keys[once], values[once]
        if kind == 1:  # needs
            return pa.table({"body": keys, "n": -values})
        starts = np.flatnonzero(np.concatenate([[True], np.diff(keys) != 0]))
        sizes = np.diff(np.concatenate([starts, [len(keys)]]))
        shared = (sizes > 1) | (values[starts] == _SHARED)
        bodies, n = np.unique(values[np.repeat(shared, sizes) & (values != _SHARED)], return_counts=True)
        return pa.table({"body": bodies, "n": n.astype(np.int64)})

    packed = _texts(docs, text).mapInArrow(spared(pack), "slice long, keys binary, values binary")
    counted = packed.groupBy("slice").applyInArrow(count, "body long, n long")
    return counted.groupBy("body").agg(F.sum("n").alias("n")).filter("n >= 0").select("body")


def _proven(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) of bodies whose sets have ``similarity``."""
    both = pairs.join(sets.toDF("a", "s"), "a").join(sets.toDF("b", "t"), "b")
    common, total = F.size(F.array_intersect("s", "t")), F.size("s") + F.size("t")
    return both.filter(common >= similarity * (total - common) - 1e-9).select("a", "b")


def _heads(sets: DataFrame, similarity: float) -> DataFrame:
    """h, body, size and place: a prefix of each set, rarest first, with each member's place in the order of the whole set.

    Two sets of ``similarity`` have a member of both prefixes. Members that one set alone has come first in its order and
    are left out of the rows, for they bring nothing together.
    """
    members = sets.select("body", F.explode("set").alias("h"))
    often = cut(members.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"))
    shared = members.join(often, "h").groupBy("body").agg(F.sort_array(F.collect_list(F.struct("n", "h"))).alias("found"))  # of one text
    sized = sets.select("body", F.size("set").alias("size"))
    lone = F.col("size") - F.size("found")
    length = F.col("size") - F.ceil(similarity * F.col("size") - 1e-9) + 1 - lone
    each = F.posexplode(F.slice("found", F.lit(1), length.cast("int")))
    return shared.join(sized, "body").filter(length > 0).select("body", "size", lone.alias("lone"), each.alias("at", "x")).select("x.h", "body", "size", (F.col("lone") + F.col("at") + 1).alias("place"))


def _largest(similarity: float) -> Column:
    """The size of the largest set that can reach ``similarity`` with this one if its member at ``place`` is the first they share."""
    return (1 + similarity) / similarity * (F.col("size") - F.col("place") + 1) - F.col("size") + 1e-6


def _to_leaders(heads: DataFrame, similarity: float) -> DataFrame:
    """Candidates (a, b): each text with the one, of those with a member of its prefix, before which fewest members come."""
    leaders = cut(heads.groupBy("h").agg(F.min(F.struct("place", "body", "size")).alias("l"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    met = heads.join(leaders, "h").filter((F.col("body") != F.col("l.body")) & (F.col("l.size") <= _largest(similarity)) & (F.col("l.size") >= similarity * F.col("size") - 1e-6))
    return met.select(F.col("body").alias("a"), F.col("l.body").alias("b"))


def _unlinked(heads: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Candidates (a, b): every pair with a member of both prefixes that may reach ``similarity`` and has not one root.

    Of such a pair, the larger set looks for the smaller one among the sets of its class of size. Most sets of a crowded
    member have one root by then; pairs inside the root that most of them have are never made.
    """
    rooted = cut(heads.join(roots, F.col("body") == F.col("node"), "left").select(*heads.columns, F.coalesce("root", "body").alias("root")))
    mixed = rooted.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("h")
    rows = cut(rooted.join(cut(mixed), "h", "left_semi"))
    level = lambda size: F.floor(F.log(size) / F.log(F.lit(CLASS)))
    reach = F.least(_largest(similarity), F.col("size").cast("double"))
    asks = rows.select("h", F.explode(F.sequence(level(F.greatest(F.lit(1.0), similarity * F.col("size") - 1e-6)), level(reach))).alias("level"),
                       F.col("body").alias("a"), F.col("size").alias("m"), _largest(similarity).alias("most"), F.col("root").alias("p"))
    held = rows.filter(_largest(similarity) >= F.col("size")).select("h", level(F.col("size").cast("double")).alias("level"), F.col("body").alias("b"), F.col("size").alias("n"), _largest(similarity).alias("upto"), F.col("root").alias("q"))
    major = cut(held.groupBy("h", "level", "q").agg(F.count("*").alias("n")).groupBy("h", "level").agg(F.max_by("q", F.struct("n", "q")).alias("major")))
    asks, held = cut(asks.join(major, ["h", "level"])), cut(held.join(major, ["h", "level"]))
    fits = (F.col("n") <= F.col("m")) & (F.col("n") <= F.col("most")) & (F.col("m") <= F.col("upto")) & (F.col("n") >= similarity * F.col("m") - 1e-6) & (F.col("p") != F.col("q"))
    strange = asks.filter("p <> major").join(held.drop("major"), ["h", "level"]).filter(fits)
    usual = asks.filter("p = major").join(held.filter("q <> major").drop("major"), ["h", "level"]).filter(fits)
    return strange.select("a", "b").union(usual.select("a", "b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def verified(docs: DataFrame, shingle: int, similarity: float, distance: int, text: str = "text") -> DataFrame:
    """doc_id, body, component_id and ``lead`` (the component's smallest body) for every row.

    Texts are linked if, and only if, a chain of texts with a Jaccard similarity of ``similarity`` or more of their
    shingles connects them; but for clashes of 64-bit hashes. Texts that can't have a partner go first (_partnered). The
    trie join over fingerprints of the distinct words (within ``distance`` bits) and leaders of rare shingles give the
    first candidates; what they miss is found by a prefix-filter join that compares every pair of texts from different
    components that can reach the similarity. All pairs are compared by their exact sets of ``shingle``-word hashes; two
    texts without words are equal. ``distance`` changes the work, not the result.
    """
    marked = cut(fingerprints(docs, 1, text, distinct=True))
    tokens = marked.agg(F.sum("count")).first()[0] or 0
    partnered = cut(_partnered(docs, tokens, shingle, similarity, text))
    firsts = marked.groupBy("body").agg(F.min("doc_id").alias("first"), F.min("fp").alias("fp"))
    texts = firsts.join(partnered, "body", "left_semi")
    sets = cut(_sets(docs, partnered, shingle, text))
    head = cut(texts.groupBy("fp").agg(F.min("body").alias("head")))
    same = texts.join(head, "fp").filter("body <> head").select(F.col("body").alias("a"), F.col("head").alias("b"))
    near = links(head.select("fp"), distance)
    across = near.join(head.toDF("a", "x"), "a").join(head.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    heads = cut(_heads(sets, similarity))
    first = same.union(across).union(_to_leaders(heads, similarity)).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    roots = cut(components(_proven(cut(first), sets, similarity)))
    missed = cut(_proven(cut(_unlinked(heads, roots, similarity)), sets, similarity))
    if not missed.isEmpty():
        of = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"_{end}"))
        ends = missed.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
        higher = cut(components(ends)).toDF("root", "above")
        moved = roots.join(higher, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
        roots = cut(moved.union(higher.select(F.col("root").alias("node"), F.col("above").alias("root"))))  # a root is no node of ``roots``
    named = cut(firsts.join(roots, F.col("body") == F.col("node"), "left").select("body", "first", F.coalesce("root", "body").alias("root")))
    least = cut(named.groupBy("root").agg(F.min("first").alias("component_id"), F.min("body").alias("lead")))
    return marked.join(cut(named.join(least, "root").select("body", "component_id", "lead")), "body").select("doc_id", "body", "component_id", "lead")


def keep(docs: DataFrame, grouped: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose doc_id is the component_id of its group in ``grouped``, with their own columns.

    Of a group in which no row has a doc_id, one row stays, if ``grouped`` has ``body`` and ``lead``.
    """
    other, mark = fresh(docs, "_kept"), fresh(docs, "_mark")
    own = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    goes = cut(grouped.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(own).alias("stays")).filter("NOT stays").select(F.col("doc_id").alias(other), F.xxhash64("doc_id").alias(mark)))
    named = docs.filter("doc_id IS NOT NULL")
    there = key_filter(goes, mark)
    open_ = named if there is None else named.filter(there(F.xxhash64(F.col("doc_id").cast("long"))))
    kept = open_.join(goes.drop(mark), F.col("doc_id") == F.col(other), "left_anti")
    if there is not None:  # most rows need no join
        kept = kept.unionByName(named.filter(~there(F.xxhash64(F.col("doc_id").cast("long")))))
    if "lead" not in grouped.columns:
        return kept
    whole = F.coalesce(F.col(text), F.lit(""))
    lone = grouped.filter("component_id IS NULL AND body = lead").select(F.col("body").alias(other)).distinct()
    nameless = docs.filter("doc_id IS NULL").withColumn(other, F.xxhash64(whole, F.length(whole)))
    return kept.unionByName(nameless.join(lone, other, "left_semi").dropDuplicates([other]).drop(other))
