"""Near-duplicate embeddings by inverted lists and product-quantised residuals, with an exact rerank.

Vectors are brought to unit length; equal ones are collapsed with their number. Each label has inverted lists of its
own, as many as its vectors need (``LIST_VECTORS`` a list, but up to ``FEW_LISTS`` of ``FEW_VECTORS`` or more in a small label;
``LISTS`` over all labels, which begins to bind beyond some two million vectors: lists grow from there on, links stay). Their centroids, and a k-means in each of ``SUBSPACES`` slices of the residuals for the codes, are
fitted on about ``SAMPLE`` distinct vectors (picked by hash; all if there are fewer); every vector is indexed.

A vector is in its own list and is a query in the others it probes. For unit vectors a cosine of ``threshold`` is a
distance t = sqrt(2 - 2 threshold), and a vector that is nearer to centroid b than to the query's own a lies at least
(d(q,b)^2 - d(q,a)^2) / (2 d(a,b)) away from q; a list is probed where that is a reach of t or less. With a reach of 1
no pair can be lost. What reach is enough depends on the data: a partner in a random direction of many dimensions hardly
moves towards any one centroid, one on a surface of few dimensions may move straight there. So it is measured: about
``QUERIES`` vectors (picked by hash) are compared with all others of their label, and the reach is the largest that any
linked pair needs from its better side, a half more (``MARGIN``), ``SPREAD`` / sqrt(d) at least and 1 at most; by label, or
over all labels where one has too few such pairs (``PAIRS``); 1 where there are too few in all. tests/llm/test_vector_dedup.py measures
links, components and ``kept`` against brute force without structure, near subspaces of 2 to 8 dimensions and on curves.

In a list, table lookups give the distance from the query to each coded vector; it is dropped where that distance less
the vector's own coding error exceeds t, which loses none. What is left is compared by cosine in double precision. The
query's links are counted there; the other vector's too if its own probes don't lead to the query.

A vector is shuffled once for each list it probes. A list of more than ``BLOCK`` rows is worked in blocks of at most
about ``BLOCK`` queries and ``BLOCK`` vectors, so a list that a third of all vectors share is spread over many tasks.
Blocks return counts by vector and edges that span their components, never all pairs.

Defined cases: vectors with a null label or vec_id, that are null, empty or zero or hold null or non-finite components
link with nothing and get n_links 0 and a component of their own; vectors of different length never link; equal rows are
copies of each other and so linked; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from evidora.llm.common import cut, hold
from evidora.llm.components import components
from evidora.llm.simhash import _join_labels

#: Production parameters.
THRESHOLD = 0.93
SUBSPACES, CODES = 8, 256
SAMPLE = 32_768
LIST_VECTORS, LISTS = 128, 16_384
FEW_LISTS, FEW_VECTORS = 8, 16
SPREAD, MARGIN, QUERIES, PAIRS = 2.0, 0.5, 2048, 100
BLOCK = 4096
BROADCAST_LISTS = 10_000
_ROUNDS = 6
_NEAR = 1 << 21


def _usable(vector: Column) -> Column:
    """Whether a vector has a direction: no null and no non-finite component, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(0, (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1))


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    step = max(1, _NEAR // len(centres))
    return np.concatenate([_squared(points[k : k + step], centres).argmin(1) for k in range(0, len(points), step)])


def _kmeans(points: np.ndarray, count: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(count, len(points)), replace=False)].copy()
    for _ in range(_ROUNDS):
        near = _nearest(points, centres)
        order = np.argsort(near, kind="stable")
        there, first = np.unique(near[order], return_index=True)
        sums = np.add.reduceat(points[order], first, axis=0)
        centres[there] = sums / np.diff(np.append(first, len(points)))[:, None]
    return centres


@dataclass
class Index:
    """The coarse centroids of each kind that has several lists, and the residuals' codebooks, by slices of equal width."""

    centres: dict[str, np.ndarray]
    books: list[np.ndarray]

    @classmethod
    def fit(cls, units: np.ndarray, kinds: np.ndarray, lists: dict[str, int]) -> Index:
        centres = {k: _kmeans(units[kinds == k], n, 1) for k, n in lists.items() if (kinds == k).any()}
        residuals = units.copy()
        for k, c in centres.items():
            own = kinds == k
            residuals[own] -= c[_nearest(units[own], c)]
        if not len(residuals):
            residuals = np.zeros((1, units.shape[1]))
        return cls(centres, [_kmeans(x, CODES, 2 + k) for k, x in enumerate(np.split(residuals, SUBSPACES, axis=1))])

    def centre(self, kind: str, of: int) -> np.ndarray | float:
        return self.centres[kind][of] if kind in self.centres else 0.0

    def encode(self, units: np.ndarray, kind: str, of: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes of vectors of list ``of``, and the distance of each vector from what its codes stand for."""
        parts = np.split(units - self.centre(kind, of), SUBSPACES, axis=1)
        codes = np.stack([_nearest(x, b) for x, b in zip(parts, self.books, strict=True)], axis=1).astype(np.uint8)
        error = np.sqrt(sum(((x - b[codes[:, k]]) ** 2).sum(1) for k, (x, b) in enumerate(zip(parts, self.books, strict=True))))
        return codes, error

    def probes(self, units: np.ndarray, kind: str, radius: float, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each vector's own list; and, as rows and lists, which lists each vector probes, its own included."""
        if kind not in self.centres:
            rows = np.arange(len(units))
            return np.zeros(len(units), np.int64), rows, np.zeros(len(units), np.int64)
        centres, homes, at, probed = self.centres[kind], [], [], []
        apart = lambda home: np.sqrt(_squared(centres[home], centres))
        step = max(1, _NEAR // len(centres))
        for k in range(0, len(units), step):
            far = _squared(units[k : k + step], centres)
            home = far.argmin(1)
            gap = far - far[np.arange(len(far)), home][:, None]
            rows, lists = np.nonzero(gap <= 2 * radius * reach * apart(home) + 1e-9)
            homes.append(home)
            at.append(rows + k)
            probed.append(lists)
        return np.concatenate(homes), np.concatenate(at), np.concatenate(probed)

    def needs(self, left: np.ndarray, right: np.ndarray, kind: str, radius: float) -> np.ndarray:
        """The least reach by which one vector of each pair probes the list of the other; 0 in one list."""
        centres = self.centres[kind]
        a, b = _nearest(left, centres), _nearest(right, centres)
        apart = np.sqrt(((centres[a] - centres[b]) ** 2).sum(1))
        side = lambda x, own, other: ((x - centres[other]) ** 2).sum(1) - ((x - centres[own]) ** 2).sum(1)
        gap = np.minimum(side(left, a, b), side(right, b, a))
        return np.where(a == b, 0.0, gap / np.where(apart > 0, 2 * radius * apart, 1.0))

    def tables(self, units: np.ndarray, kind: str, of: int) -> list[np.ndarray]:
        """Squared distances from each vector's residual in list ``of`` to every code, by slice."""
        return [_squared(x, b) for x, b in zip(np.split(units - self.centre(kind, of), SUBSPACES, axis=1), self.books, strict=True)]


def _units(column, width: int) -> np.ndarray:
    """Unit vectors as rows, padded with zeros to ``width``."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    out /= np.abs(out).max(1, keepdims=True)  # against overflow of the squares
    return out / np.sqrt((out**2).sum(1, keepdims=True))


def _index(vectors: DataFrame, width: int, total: int) -> Index:
    """The index of ``vectors`` (id, kind, n, vector): kinds of so many vectors that they need several lists are fitted."""
    share, few = max(LIST_VECTORS, total / LISTS), max(min(FEW_VECTORS, LIST_VECTORS), total / LISTS)
    sizes = vectors.groupBy("kind").agg(F.count("*").alias("of")).filter(F.col("of") > 2 * few)
    lists = {r.kind: int(-(-max(r.of / share, min(FEW_LISTS, r.of / few)) // 1)) for r in sizes.collect()}  # LISTS / 2 rows at most
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(0), "vector"), 11) / float(1 << 53)
    sample = vectors.filter(unit < SAMPLE / total).select("kind", "vector").toArrow().combine_chunks()
    if not sample.num_rows:
        return Index.fit(np.zeros((0, width)), np.zeros(0, object), {})
    return Index.fit(_units(sample.column("vector").chunk(0), width), np.asarray(sample.column("kind").to_pylist(), object), lists)


def _reaches(vectors: DataFrame, index, width: int, total: int, threshold: float, radius: float, least: float) -> dict[str, float]:
    """The reach for each kind that has several lists, from the linked pairs of a sample of queries with all vectors."""
    kinds = sorted(index.value.centres)
    if not kinds:
        return {}
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(5), "vector"), 11) / float(1 << 53)
    chosen = vectors.filter((unit < QUERIES / total) & F.col("kind").isin(kinds)).select("id", "kind", "vector").toArrow().combine_chunks()  # about QUERIES
    if not chosen.num_rows:
        return dict.fromkeys(kinds, 1.0)
    one = lambda name: (c.chunk(0) if hasattr(c := chosen.column(name), "chunk") else c)
    asked = vectors.sparkSession.sparkContext.broadcast((one("id").to_numpy(), np.asarray(one("kind").to_pylist(), object), _units(one("vector"), width)))

    def measure(batches):
        import pyarrow as pa

        hold("vectors")
        ids, of, queries = asked.value
        for batch in batches:
            if not batch.num_rows:
                continue
            own, found = batch.column("kind").to_numpy(zero_copy_only=False), ([], [], [])
            units, names = _units(batch.column("vector"), width), batch.column("id").to_numpy()
            for kind in np.intersect1d(np.unique(own), np.unique(of)):
                at, q = np.flatnonzero(own == kind), np.flatnonzero(of == kind)
                x, y = np.nonzero(units[at] @ queries[q].T >= threshold)
                x, y = at[x], q[y]
                fine = names[x] != ids[y]
                x, y = x[fine], y[fine]
                if len(x):
                    step = max(1, _NEAR // width)
                    need = max(float(index.value.needs(units[x[k : k + step]], queries[y[k : k + step]], kind, radius).max()) for k in range(0, len(x), step))
                    for column, value in zip(found, (kind, len(x), need), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.string()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())], ["kind", "pairs", "need"])

    seen = vectors.select("id", "kind", "vector").filter(F.col("kind").isin(kinds)).mapInArrow(measure, "kind string, pairs long, need double")
    by = {r.kind: (r.pairs, r.need) for r in seen.groupBy("kind").agg(F.sum("pairs").alias("pairs"), F.max("need").alias("need")).collect()}  # LISTS / 2 rows at most
    every = sum(n for n, _ in by.values()), max((x for _, x in by.values()), default=0.0)

    def reach(kind: str) -> float:
        pairs, need = by.get(kind, (0, 0.0))
        pairs, need = (pairs, need) if pairs >= PAIRS else every
        return min(1.0, max(least, need * (1 + MARGIN))) if pairs >= PAIRS else 1.0

    return {kind: reach(kind) for kind in kinds}


def _solve(index: Index, kind: str, of: int, width: int, threshold: float, radius: float, ids, copies, units, home, probes, role):
    """Counts by row and labels (each row's smallest linked row) of one block; ``probes``: flat lists and their starts."""
    q, b = np.flatnonzero(role & 2), np.flatnonzero(role & 1)
    counts, labels = np.zeros(len(ids), np.int64), np.arange(len(ids))
    if not len(b) or not len(q):
        return counts, labels
    codes, error = index.encode(units[b], kind, of)
    flat, starts = probes
    step = int(max(1, _NEAR // len(b)))
    for k in range(0, len(q), step):
        part = q[k : k + step]
        far = sum(t[:, codes[:, j]] for j, t in enumerate(index.tables(units[part], kind, of)))
        x, y = np.nonzero(far <= (radius + error[None, :]) ** 2)
        for m in range(0, len(x), _NEAR // width):
            u, v = part[x[m : m + _NEAR // width]], b[y[m : m + _NEAR // width]]
            good = (ids[u] != ids[v]) & (np.einsum("ij,ij->i", units[u], units[v]) >= threshold)
            u, v = u[good], v[good]
            np.add.at(counts, u, copies[v])
            wide = int((starts[v + 1] - starts[v]).max(initial=0))
            back = np.zeros(len(u), bool)  # whether v probes the list of u, and so counts the pair itself
            for j in range(wide):
                there = starts[v] + j < starts[v + 1]
                back[there] |= flat[starts[v[there]] + j] == home[u[there]]
            np.add.at(counts, v[~back], copies[u[~back]])
            _join_labels(labels, np.minimum(u, v), np.maximum(u, v))
    return counts, labels


def links(vectors: DataFrame, threshold: float = THRESHOLD, spread: float = SPREAD) -> tuple[DataFrame, DataFrame]:
    """For distinct vectors (id, kind, n, vector): n_links by id, and edges (a, b) that span the components.

    ``kind`` says which vectors may be compared, ``n`` how many copies a vector stands for.
    """
    spark = vectors.sparkSession
    total, width = vectors.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not total:
        return spark.createDataFrame([], "id long, n_links long"), spark.createDataFrame([], "a long, b long")
    least = min(1.0, spread / width**0.5)
    width = -(-width // SUBSPACES) * SUBSPACES
    radius = float(np.sqrt(2 - 2 * threshold)) + 1e-9
    index = spark.sparkContext.broadcast(_index(vectors, width, total))
    reaches = _reaches(vectors, index, width, total, threshold, radius, least)

    def place(batches):
        import pyarrow as pa

        hold("vectors")
        for batch in batches:
            if not batch.num_rows:
                continue
            units, kinds = _units(batch.column("vector"), width), batch.column("kind").to_numpy(zero_copy_only=False)
            home, at, probed = np.zeros(len(units), np.int64), [], []
            for kind in np.unique(kinds):
                own = np.flatnonzero(kinds == kind)
                home[own], rows, lists = index.value.probes(units[own], kind, radius, reaches.get(kind, 1.0))
                at.append(own[rows])
                probed.append(lists)
            at, probed = np.concatenate(at), np.concatenate(probed)
            order = np.lexsort((probed, at))
            at, probed = at[order], probed[order]
            starts = np.searchsorted(at, np.arange(len(units) + 1))
            every = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(probed.astype(np.int32)))
            taken, rows = batch.take(pa.array(at)), every.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(probed.astype(np.int32)), pa.array(home[at].astype(np.int32)), rows], [*taken.schema.names, "list", "home", "probes"])

    kind = vectors.schema["vector"].dataType.simpleString()
    columns = ["id", "kind", "n", "vector", "list", "home", "probes"]
    dealt = vectors.select("id", "kind", "n", "vector").mapInArrow(place, f"id long, kind string, n long, vector {kind}, list int, home int, probes array<int>")
    own = F.col("home") == F.col("list")
    sizes = dealt.groupBy("kind", "list").agg(F.ceil(F.count_if(own) / BLOCK).alias("bases"), F.ceil(F.count("*") / BLOCK).alias("queries"))
    hot = cut(sizes.filter("queries > 1"))
    keys = ["kind", "list", "qblock", "bblock"]
    role = F.when(own, 3).otherwise(2).alias("role")
    whole = (F.lit(0).alias("qblock"), F.lit(0).alias("bblock"))
    if count := hot.count():
        hot = F.broadcast(hot) if count <= BROADCAST_LISTS else hot
        slot = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30))
        known = dealt.join(hot, ["kind", "list"])
        every = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
        asked = known.filter("bases > 0").select(*columns, F.pmod(slot, "queries").cast("int").alias("qblock"), every("bases").alias("bblock"), F.lit(2).alias("role"))
        held = known.filter(own).select(*columns, every("queries").alias("qblock"), F.pmod(slot, "bases").cast("int").alias("bblock"), F.lit(1).alias("role"))
        blocks = dealt.join(hot, ["kind", "list"], "left_anti").select(*columns, *whole, role).unionByName(asked).unionByName(held)
    else:
        blocks = dealt.select(*columns, *whole, role)
    blocks = blocks.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        import pyarrow as pa

        hold("vectors")

        def solved(table):
            rows = table.combine_chunks().to_batches()[0]
            ids = rows.column("id").to_numpy()
            lists = rows.column("probes")
            probes = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
            counts, labels = _solve(index.value, rows.column("kind")[0].as_py(), rows.column("list")[0].as_py(), width, threshold, radius, ids, rows.column("n").to_numpy(),
                                    _units(rows.column("vector"), width), rows.column("home").to_numpy(), probes, rows.column("role").to_numpy())
            linked, some = np.flatnonzero(labels != np.arange(len(ids))), counts > 0
            to = pa.array(np.concatenate([np.zeros(int(some.sum()), np.int64), ids[labels[linked]]]), mask=np.arange(int(some.sum()) + len(linked)) < some.sum())
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([ids[some], ids[linked]])), pa.array(np.concatenate([counts[some], np.zeros(len(linked), np.int64)])), to], ["id", "n_links", "to"])

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            new = np.zeros(max(0, table.num_rows - 1), bool)
            for key in keys:
                column = table.column(key).combine_chunks()
                column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
                values = column.dictionary_encode().indices.to_numpy() if key == "kind" else column.to_numpy()
                new |= values[1:] != values[:-1]
            edges = [0, *(np.flatnonzero(new) + 1).tolist()]
            for start, stop in zip(edges, edges[1:], strict=False):
                yield solved(table.slice(start, stop - start))
            held = table.slice(edges[-1])
        if held is not None and held.num_rows:
            yield solved(held)

    found = cut(blocks.select(*columns, "qblock", "bblock", "role").mapInArrow(run, "id long, n_links long, to long"))
    counted = found.filter("to IS NULL").groupBy("id").agg(F.sum("n_links").alias("n_links"))
    return counted, found.filter("to IS NOT NULL").select(F.col("id").alias("a"), F.col("to").alias("b"))


def group(rows: DataFrame, threshold: float = THRESHOLD, spread: float = SPREAD, vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    single = isinstance(getattr(rows.schema[vector].dataType, "elementType", None), FloatType)
    exact = F.col(vector) if single else F.col(vector).cast("array<double>")  # single precision is in double precision exactly
    slim = rows.select(F.col("vec_id").cast("long").alias("vec_id"), exact.alias("vector"), F.col(label).cast("string").alias("_label"))
    usable = _usable(F.col("vector")) & F.col("_label").isNotNull() & F.col("vec_id").isNotNull()
    kind = F.when(usable, F.concat_ws(":", F.size("vector").cast("string"), "_label"))
    keyed = slim.select("vec_id", "vector", kind.alias("kind"))
    distinct = cut(keyed.filter("kind IS NOT NULL").groupBy("kind", "vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")))
    counted, edges = links(distinct, threshold, spread)
    roots = components(edges)
    named = distinct.join(counted, "id", "left").join(roots, F.col("id") == F.col("node"), "left").select(
        F.col("kind").alias("_kind"), F.col("vector").alias("_vector"), (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    joined = keyed.join(named, (F.col("kind") == F.col("_kind")) & (F.col("vector") == F.col("_vector")), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
