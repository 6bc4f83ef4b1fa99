"""Vectors compared in blocks of matrices, a spanning forest, a similarity join by bands, and a stored index of inverted lists.

Exact comparison of all vectors of a group is quadratic; here it is dealt out in pairs of parts of ``PART`` vectors at most,
so no task holds a group whole, and a task returns the few rows that are asked for, never the pairs.

Everywhere: vectors that are null, empty or zero, or hold null or non-finite components, have no direction: they are
compared with nothing. Vectors of different length, and of different or null block, aren't compared either. Ids are whole numbers.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidora.operators.commits import Files
from evidora.shared import stored, written

#: Vectors of a part; vectors that an index is fitted on, vectors a list, lists at most, and rounds of the fit.
PART = 2048
SAMPLE, LIST, LISTS, ROUNDS = 20_000, 256, 4096, 6
#: Queries by which an index counts its probes, and the share of their true neighbours that these must find.
QUERIES, RECALL = 500, 0.97
#: The share of pairs at the threshold that bands may miss, the vectors that a band's bucket is to hold on average, copies of vectors
#: that a worker makes at once and that a task makes.
MISSED, BUCKET, COPIES, TASK_COPIES = 0.005, 256, 8192, 500_000


def directed(vector: Column) -> Column:
    """Whether a vector has a direction."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _comparable(vectors: DataFrame, block: str) -> DataFrame:
    """id, vector (doubles, floats where they were) and _group (length and block) of the vectors that can be compared with others."""
    kind = "array<float>" if vectors.schema["vector"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select("id", F.col("vector").cast(kind).alias("vector"), F.col(block).cast("string").alias("_of"))
    return rows.filter(directed(F.col("vector")) & F.col("_of").isNotNull()).select("id", "vector", F.concat_ws(":", F.size("vector").cast("string"), "_of").alias("_group"))


def _parted(held: DataFrame, part: int) -> DataFrame:
    """``held`` with the number of parts of their group and their own part."""
    sizes = held.groupBy("_group").agg(F.ceil(F.count("*") / part).cast("int").alias("_parts"))
    return held.join(sizes, "_group").withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int"))


def unit_rows(column) -> np.ndarray:
    """The vectors of an Arrow column, all of one length, as unit rows."""
    rows = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    rows = rows.chunk(0) if hasattr(rows, "chunk") else rows
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
    flat /= np.abs(flat).max(1, keepdims=True, initial=0) if flat.size else 1  # against overflow of the squares
    return flat / np.sqrt((flat**2).sum(1, keepdims=True))


def _ids(column) -> np.ndarray:
    return np.asarray(column.to_numpy(), np.int64)


def nearest(queries: DataFrame, vectors: DataFrame, k: int, block: str, part: int = PART) -> DataFrame:
    """query, id, similarity (six places) and rank: the ``k`` vectors most like each query in its block, ties by id; exact.

    Each task compares the queries of a block, in parts, with one part of its vectors, and returns ``k`` rows a query.
    """
    held = _parted(_comparable(vectors, block), part)
    sizes = held.select("_group", "_parts").distinct()
    asked = _comparable(queries, block).join(sizes, "_group").select(F.col("_group").alias("_for"), F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), F.col("id").alias("query"), F.col("vector").alias("asked"))

    def compare(q, v):
        import pyarrow as pa

        out = [[], [], []]
        if q.num_rows and v.num_rows:
            ids, units = _ids(v.column("vid")), unit_rows(v.column("vector"))
            for start in range(0, q.num_rows, 1024):
                own = q.slice(start, 1024)
                found = np.round(unit_rows(own.column("asked")) @ units.T, 6)
                for query, row in zip(_ids(own.column("query")).tolist(), found, strict=True):
                    places = [i for i in np.lexsort((ids, -row))[: k + 1] if ids[i] != query][:k]
                    out[0] += [query] * len(places)
                    out[1] += ids[places].tolist()
                    out[2] += row[places].tolist()
        return pa.table({"query": pa.array(out[0], pa.int64()), "id": pa.array(out[1], pa.int64()), "similarity": pa.array(out[2], pa.float64())})

    kept = held.select(F.col("_group").alias("_of"), F.col("_own").alias("_at"), F.col("id").cast("long").alias("vid"), "vector")
    some = asked.groupBy("_for", "_part").cogroup(kept.groupBy("_of", "_at")).applyInArrow(compare, "query long, id long, similarity double")
    return _ranked(some, k)


def _ranked(some: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), "id"))
    return some.withColumn("rank", rank).filter(F.col("rank") <= k)


def _met(parted: DataFrame, *keys: str) -> DataFrame:
    """Every pair of parts of a group (``keys``): _lo and _hi with the vectors of both."""
    met = parted.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return met.select(*keys, F.least("_own", "_other").alias("_lo"), F.greatest("_own", "_other").alias("_hi"), F.col("id").cast("long").alias("id"), "vector")


def _pairs_of_parts(held: DataFrame, part: int) -> DataFrame:
    return _met(_parted(held, part), "_group")


def _linked(met: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) that span what cosines of ``threshold`` (six places) connect within the groups of ``met``, by all columns but id and vector."""

    def compare(rows):
        import pyarrow as pa

        ids, units = _ids(rows.column("id")), unit_rows(rows.column("vector"))
        root = np.arange(len(ids))
        for start in range(0, len(ids), 1024):
            x, y = np.nonzero(np.round(units[start : start + 1024] @ units.T, 6) >= threshold)
            x, y = root[x + start], root[y]
            while (open_ := x != y).any():  # lowers the roots until both ends of every edge have one
                x, y = x[open_], y[open_]
                np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
                while (root[root] != root).any():
                    root = root[root]
                x, y = root[x], root[y]
        linked = np.flatnonzero(root != np.arange(len(ids)))
        return pa.table({"a": pa.array(ids[linked]), "b": pa.array(ids[root[linked]])})

    return met.groupBy(*[c for c in met.columns if c not in ("id", "vector")]).applyInArrow(compare, "a long, b long").distinct()


def near_edges(vectors: DataFrame, threshold: float, block: str, part: int = PART) -> DataFrame:
    """Edges (a, b) that connect exactly the vectors of a block that a chain of cosines of ``threshold`` (six places) connects.

    Every pair of parts is compared in one task, which returns edges that span its components.
    """
    return _linked(_pairs_of_parts(_comparable(vectors, block), part), threshold)


def bands_for(threshold: float, size: int) -> tuple[int, int]:
    """(bits, bands): hyperplanes of a band, so that ``size`` vectors fill buckets of ``BUCKET``, and as many bands as find
    all but ``MISSED`` of the pairs at the threshold. Hyperplanes part a pair at an angle a with a chance of a / pi."""
    bits = max(4, math.ceil(math.log2(max(1, size / BUCKET))))
    same = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISSED) / math.log1p(-same))) if same < 1 else 1


def banded_edges(vectors: DataFrame, threshold: float, block: str, part: int = PART) -> DataFrame:
    """As ``near_edges``, without comparing all pairs of a block: vectors meet that lie on the same side of all hyperplanes
    of a band, and are then compared exactly.

    No edge joins what ``near_edges`` keeps apart. A pair at the threshold is missed with a chance of ``MISSED``, a nearer one with a smaller one. Buckets
    stay small as a block grows, and the bands that takes grow as a small power of its size. A bucket of more than
    ``part`` vectors, such as copies, is dealt in pairs of parts like any block.
    """
    held = written(_comparable(vectors, block))
    size, total = held.groupBy("_group").agg(F.count("*").alias("n")).agg(F.max("n"), F.sum("n")).first()
    bits, bands = bands_for(threshold, size or 0)
    dealt = held.select(F.col("id").cast("long").alias("id"), "vector", "_group").repartition(max(1, math.ceil((total or 0) * bands / TASK_COPIES)), "id")

    def signed(batches):
        """The rows of some batches, few enough at a time that all bands make ``COPIES``, with a number for each band and its side."""
        import pyarrow as pa

        planes: dict[int, np.ndarray] = {}
        weights, first, step = 1 << np.arange(bits, dtype=np.int64), np.arange(bands, dtype=np.int64) << bits, max(1, COPIES // bands)
        for batch in batches:
            lengths = np.diff(batch.column("vector").offsets.to_numpy())
            for length in np.unique(lengths).tolist():
                places = np.flatnonzero(lengths == length)
                if length not in planes:
                    planes[length] = np.random.default_rng(length).normal(size=(length, bits * bands))
                for start in range(0, len(places), step):
                    own = batch.take(pa.array(places[start : start + step]))
                    yield own, (unit_rows(own.column("vector")) @ planes[length] > 0).reshape(own.num_rows, bands, bits) @ weights + first

    def sign(batches):
        import pyarrow as pa

        for own, sides in signed(batches):
            copies = own.take(pa.array(np.repeat(np.arange(own.num_rows), bands)))
            yield pa.RecordBatch.from_arrays([*copies.columns, pa.array(sides.ravel())], ["id", "vector", "_group", "_side"])

    def name(batches):
        import pyarrow as pa

        for own, sides in signed(batches):
            yield pa.RecordBatch.from_arrays([own.column("_group").take(pa.array(np.repeat(np.arange(own.num_rows), bands))), pa.array(sides.ravel())], ["_group", "_side"])

    counts = dealt.mapInArrow(name, "_group string, _side long").groupBy("_group", "_side").agg(F.ceil(F.count("*") / part).cast("int").alias("_parts"))
    crowded = stored(counts.filter("_parts > 1"))
    small = dealt.mapInArrow(sign, f"id long, vector {held.schema['vector'].dataType.simpleString()}, _group string, _side long")
    parted = small.join(crowded, ["_group", "_side"], "left").withColumn("_parts", F.coalesce("_parts", F.lit(1))).withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int"))
    return _linked(_met(parted, "_group", "_side"), threshold)


def _tree(ids: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spanning tree of greatest similarities (six places; ties by the smaller ids) of some vectors: a, b and similarity."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    ids, units = ids[order], units[order]
    free, best, near = np.ones(n, bool), np.full(n, -np.inf), np.zeros(n, np.int64)
    at, out = 0, []
    for _ in range(n - 1):
        free[at] = False
        row = np.round(units @ units[at], 6)
        # of edges to one vertex the more similar wins, then the one that comes first as a pair of ids
        lower = np.minimum(at, np.arange(n)), np.maximum(at, np.arange(n))
        held = np.minimum(near, np.arange(n)), np.maximum(near, np.arange(n))
        first = (lower[0] < held[0]) | (lower[0] == held[0]) & (lower[1] < held[1])
        better = free & ((row > best) | (row == best) & first)
        best[better], near[better] = row[better], at
        left = np.flatnonzero(free)
        top = left[best[left] == best[left].max()]
        a, b = np.minimum(near[top], top), np.maximum(near[top], top)
        at = int(top[np.lexsort((b, a))[0]])
        out.append((ids[min(near[at], at)], ids[max(near[at], at)], best[at]))
    a, b, s = zip(*out, strict=True) if out else ((), (), ())
    return np.asarray(a, np.int64), np.asarray(b, np.int64), np.asarray(s, np.float64)


def spanning_forest(vectors: DataFrame, block: str, part: int = PART) -> DataFrame:
    """a < b, similarity (six places): the spanning tree of greatest similarities of each block.

    An edge that isn't in the tree of some of a block's vectors isn't in that of all, so each pair of parts returns its own
    tree only, and Borůvka rounds over these edges give the forest: every component takes its best edge out, with ties
    in one fixed order (similarity, a, b), until none has any. Ids are unique. Joins shuffle both sides: a broadcast one passes
    through the driver, which in all rounds is much.
    """
    held = _comparable(vectors, block)

    def compare(rows):
        import pyarrow as pa

        a, b, s = _tree(_ids(rows.column("id")), unit_rows(rows.column("vector")))
        return pa.table({"a": pa.array(a), "b": pa.array(b), "similarity": pa.array(s)})

    edges = stored(_pairs_of_parts(held, part).groupBy("_group", "_lo", "_hi").applyInArrow(compare, "a long, b long, similarity double").distinct())
    rank = F.struct(F.col("similarity"), -F.col("a"), -F.col("b"))
    open_ = edges.select("a", "b", "similarity", F.col("a").alias("ca"), F.col("b").alias("cb"))  # with the components of both ends
    forest = None
    while True:
        ends = open_.select(F.col("ca").alias("c"), F.col("cb").alias("to"), rank.alias("rank")).union(open_.select(F.col("cb").alias("c"), F.col("ca").alias("to"), rank.alias("rank")))
        best = stored(ends.groupBy("c").agg(F.max(F.struct("rank", "to")).alias("x")).select("c", "x.to", "x.rank.*").toDF("c", "to", "similarity", "a", "b"))
        if best.isEmpty():
            return forest if forest is not None else edges
        own = best.select((-F.col("a")).alias("a"), (-F.col("b")).alias("b"), "similarity").distinct()
        forest = own if forest is None else forest.union(own)
        # chosen edges make trees with one pair that chose each other; its smaller end is the root
        back = best.select(F.col("c").alias("_c"), F.col("to").alias("_back"))
        hooks = best.join(back.hint("merge"), F.col("to") == F.col("_c")).select("c", F.when((F.col("_back") == F.col("c")) & (F.col("c") < F.col("to")), F.col("c")).otherwise(F.col("to")).alias("up"))
        hooks = stored(hooks)
        while True:
            above = hooks.select(F.col("c").alias("_c"), F.col("up").alias("_up"))
            jumped = stored(hooks.join(above.hint("merge"), F.col("up") == F.col("_c")).select("c", F.col("_up").alias("up"), (F.col("_up") != F.col("up")).alias("moved")))
            hooks = jumped.select("c", "up")
            if jumped.filter("moved").isEmpty():
                break
        of = lambda name: hooks.select(F.col("c").alias(name), F.col("up").alias(f"n{name}")).hint("merge")
        open_ = stored(open_.join(of("ca"), "ca").join(of("cb"), "cb").filter("nca <> ncb").select("a", "b", "similarity", F.col("nca").alias("ca"), F.col("ncb").alias("cb")))


def placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``place`` (from 1) by ``order``, without one task for all: ranges first, then places within each."""
    dealt = written(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    counts = sorted(dealt.groupBy("_part").agg(F.count("*").alias("n")).collect())  # a row a partition
    shifts, total = {}, 0
    for part, n in counts:
        shifts[part] = total
        total += n
    table = F.create_map(*[F.lit(x) for pair in shifts.items() for x in pair]) if shifts else F.lit(None).cast("map<int,int>")
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.withColumn("place", (table[F.col("_part")] + inner).cast("long")).drop("_part")


def _fit(units: np.ndarray, lists: int) -> np.ndarray:
    centres = units[np.random.default_rng(1).choice(len(units), min(lists, len(units)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = (units @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, units)
        norm = np.sqrt((sums**2).sum(1, keepdims=True))
        centres = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres)
    return centres


class Index:
    """Inverted lists, stored: ``vectors`` as a table partitioned by list, and beside it the centroids and what was measured.

    Centroids are fitted on about ``SAMPLE`` vectors (all if there are fewer), unit vectors of one length, the commonest;
    every vector of that length that has a direction is in the list of the nearest centroid. ``probes`` is measured when the
    index is made: for about ``QUERIES`` vectors, compared with all, as many lists as hold ``RECALL`` of their true
    neighbours. A search reads the partitions of the probed lists only. ``exact`` looks, after that, into all other lists that
    can hold a nearer vector than the k-th found, by each list's stored radius, and so misses none.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        self.meta = json.loads(Files(spark, path).read("index.json"))
        self._centres = spark.sparkContext.broadcast(np.asarray(self.meta["centres"], np.float64).reshape(len(self.meta["centres"]), self.meta["width"] or 1))

    @property
    def probes(self) -> int:
        return self.meta["probes"]

    @property
    def lists(self) -> int:
        return len(self.meta["centres"])

    @classmethod
    def make(cls, vectors: DataFrame, path: str, lists: int | None = None, neighbours: int = 10) -> Index:
        """Fits, stores and measures an index of ``vectors`` (id, vector) at ``path``, which holds nothing yet."""
        spark = vectors.sparkSession
        rows = vectors.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector")).filter(directed(F.col("vector")))
        sizes = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
        width, total = sizes.agg(F.max_by("width", F.struct("n", "width")), F.max("n")).first()
        width, total = width or 0, total or 0
        rows = rows.filter(F.size("vector") == width)
        unit = lambda seed: F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 11) / float(1 << 53)
        sample = rows.filter(unit(0) < SAMPLE / max(1, total)).select("vector").toArrow().column(0)
        centres = _fit(unit_rows(sample), min(LISTS, lists or max(1, total // LIST))) if len(sample) else np.zeros((0, width))
        files = Files(spark, path)
        meta = {"width": width, "centres": centres.tolist(), "probes": 1}
        if not files.create_once("index.json", json.dumps(meta)):
            raise FileExistsError(path)
        index = cls(spark, path)
        index.add(rows)
        queries = rows.filter(unit(3) < QUERIES / max(1, total))
        true = nearest(queries.withColumn("_all", F.lit(0)), rows.withColumn("_all", F.lit(0)), neighbours, "_all")
        homes = index._placed(rows, 1).select(F.col("id").alias("_id"), F.col("list").alias("_home"))
        ranks = index._placed(queries, max(1, index.lists), ("id",)).select(F.col("id").alias("_query"), F.col("list").alias("_list"), F.col("nth").alias("_nth"))
        met = true.join(homes, F.col("id") == F.col("_id")).join(ranks, (F.col("query") == F.col("_query")) & (F.col("_home") == F.col("_list")))
        counts = sorted(met.groupBy("_nth").agg(F.count("*").alias("n")).collect())  # a row a list at most
        wanted, seen = RECALL * sum(n for _, n in counts), 0
        for nth, n in counts:
            seen += n
            if seen >= wanted:
                meta["probes"] = nth + 1
                break
        files.delete("index.json")
        files.create_once("index.json", json.dumps(meta))
        return cls(spark, path)

    def add(self, vectors: DataFrame) -> None:
        """Adds the vectors whose id isn't there yet; a repeated one is taken once."""
        rows = vectors.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
        rows = rows.filter(directed(F.col("vector")) & (F.size("vector") == self.meta["width"]) & F.col("id").isNotNull()).dropDuplicates(["id"])
        if Files(self._spark, self._path).exists("vectors"):
            rows = rows.join(self._stored().select("id"), "id", "left_anti")
        placed_ = self._placed(rows, 1).select("id", "vector", "away", "list")
        placed_.repartition("list").write.mode("append").partitionBy("list").parquet(f"{self._path}/vectors")

    def _stored(self) -> DataFrame:
        return self._spark.read.schema("id long, vector array<double>, away double, list int").parquet(f"{self._path}/vectors")

    def _placed(self, rows: DataFrame, probes: int, carry: tuple[str, ...] = ("id", "vector")) -> DataFrame:
        """The columns ``carry`` of ``rows`` once for each of the ``probes`` nearest lists, with list, nth (from 0) and away (an angle)."""
        centres, rows = self._centres, rows.select("id", "vector")

        def run(batches):
            import pyarrow as pa

            for batch in batches:
                if not batch.num_rows or not len(centres.value):
                    continue
                like = np.clip(unit_rows(batch.column("vector")) @ centres.value.T, -1, 1)
                near = np.argsort(-like, axis=1, kind="stable")[:, :probes]
                taken = batch.select(list(carry)).take(pa.array(np.repeat(np.arange(batch.num_rows), near.shape[1])))
                away = np.arccos(np.take_along_axis(like, near, 1))
                more = [pa.array(near.ravel().astype(np.int32)), pa.array(np.tile(np.arange(near.shape[1], dtype=np.int32), batch.num_rows)), pa.array(away.ravel())]
                yield pa.RecordBatch.from_arrays([*taken.columns, *more], [*taken.schema.names, "list", "nth", "away"])

        fields = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in carry)
        return rows.mapInArrow(run, f"{fields}, list int, nth int, away double")

    def pruned(self, lists: list[int]) -> DataFrame:
        """The stored vectors of some lists; other partitions aren't read."""
        return self._stored().filter(F.col("list").isin(lists))

    def search(self, queries: DataFrame, k: int, probes: int | None = None, exact: bool = False) -> DataFrame:
        """query, id, similarity (six places) and rank of the ``k`` vectors found most like each query, itself left out."""
        asked = queries.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector")).filter(directed(F.col("vector")) & (F.size("vector") == self.meta["width"]))
        near = written(self._placed(asked, probes or self.probes).select("id", "vector", "list"))
        found = self._looked_up(near, k)
        if not exact:
            return found
        found = written(found)
        kth = found.groupBy("query").agg(F.count("*").alias("n"), F.min("similarity").alias("kth"))
        reach = F.when(F.col("n") == k, F.acos(F.greatest(F.col("kth") - 1e-6, F.lit(-1.0)))).otherwise(math.pi)
        radii = self._stored().groupBy("list").agg(F.max("away").alias("radius")).withColumnRenamed("list", "_list")
        open_ = self._placed(asked, max(1, self.lists), ("id",)).join(F.broadcast(radii), F.col("list") == F.col("_list")).join(kth, F.col("id") == F.col("query"), "left")
        open_ = open_.filter(F.col("away") - F.col("radius") <= F.coalesce(reach, F.lit(math.pi)) + 1e-6).select("id", "list")
        rest = open_.join(near.select("id", "list"), ["id", "list"], "left_anti").join(asked, "id").select("id", "vector", "list")
        return _ranked(found.drop("rank").union(self._looked_up(written(rest), k).drop("rank")), k)

    def _looked_up(self, near: DataFrame, k: int) -> DataFrame:
        lists = [r.list for r in near.select("list").distinct().collect()]  # ``LISTS`` at most
        return _ranked(nearest(near, self.pruned(lists), k, "list").drop("rank"), k)
