"""Embedding whitening with an exact covariance: digit-slice matrix products, merged as big integers, then eigenvectors.

A component c of a vector becomes the integer x = floor(``SCALE`` c) + ``SHIFT``. Integers are split into signed limbs of
``LIMB`` bits, so that every product of two limb matrices over at most ``SLICE`` rows stays below 2^53 and a float64 BLAS
product is exact. A task adds the products up by their weight, recombines them as big integers once, and returns the
upper triangle of its Gram matrix (a column of ones gives the sums and the count) as digits of 32 bits; Spark sums these
by place, and the driver puts the sums together: (width + 1)^2 numbers, however many vectors there are. The covariance
(n G - S S') / n^2 is thus centred in integers and rounded once, to a double, before the eigenvectors are taken.

A second pass projects each vector, from its integer distance to the floor of the mean, and gives its exact squared
deviation. A third pass over the written projections measures how far their covariance, centred before multiplying, is
from the identity.

Defined cases: vectors that are null or hold null or non-finite components are dropped; a null vec_id stays. The width is
the commonest length among the others (the longest of those as common); a vector of another length takes no part in
the fit and has null ``deviation`` and ``whitened``. Equal rows count as often as they come. A component without variance
(one row, equal rows, fewer directions than components) has null ``whitened``, ``explained`` 0 or nearly so, and is left
out of ``identity_error``, which is 0 where none is left. Integers beyond 2^61 are held there. A ``deviation`` of more
than 38 digits is null. An empty table, or one of empty vectors, gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from evidora.llm.common import cut, fresh, hold

#: Production parameters. SHIFT and SCALE are fixed by the contract of the result.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LIMB, SLICE = 16, 1 << 16
_LARGEST = 2.0**61
_DIGIT = 32
#: Rows after which a task returns what it has summed, so that sums of limb products stay below 2^63.
_FLUSH = 1 << 29


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def integers(column, width: int) -> np.ndarray:
    """The vectors of an Arrow list column, all of length ``width``, as rows of integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width) * SCALE)
    return np.clip(scaled, -_LARGEST, _LARGEST).astype(np.int64) + SHIFT


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """Matrices of integers from -2^15 to 2^15 - 1 with x as the sum of limb k times 2^(16 k)."""
    found, half = [], 1 << (LIMB - 1)
    while x.any():
        low = ((x + half) & ((1 << LIMB) - 1)) - half
        found.append(low.astype(np.float64))
        x = (x - low) >> LIMB
    return found


def add_products(planes: dict[int, np.ndarray], x: np.ndarray) -> None:
    """Adds x'x to ``planes``: an integer matrix for each power of 2^16."""
    for at in range(0, len(x), SLICE):
        limbs = _limbs(x[at : at + SLICE])
        for a, left in enumerate(limbs):
            for b, right in enumerate(limbs[a:], a):
                product = (left.T @ right).astype(np.int64)
                planes[a + b] = planes.get(a + b, 0) + (product if a == b else product + product.T)


def recombined(planes: dict[int, np.ndarray]) -> np.ndarray:
    """The sum of the planes by their weight, as an array of Python integers."""
    return sum(plane.astype(object) << (LIMB * k) for k, plane in planes.items())


def _digits(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Signed digits of ``_DIGIT`` bits of an array of Python integers, lowest first."""
    half, k = 1 << (_DIGIT - 1), 0
    while values.any():
        low = ((values + half) & ((1 << _DIGIT) - 1)) - half
        yield k, low.astype(np.int64)
        values, k = (values - low) >> _DIGIT, k + 1


@dataclass
class Model:
    """What a fit leaves: the count, the sums, the leading unit eigenvectors as rows, their eigenvalues and the trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @classmethod
    def solve(cls, gram: np.ndarray, count: int) -> Model:
        """From the exact Gram matrix, whose last row and column hold the sums and the count."""
        n, sums = gram[-1, -1], gram[-1, :-1]
        centred = n * gram[:-1, :-1] - np.outer(sums, sums)
        values, vectors = np.linalg.eigh((centred / (n * n)).astype(np.float64))
        order = np.argsort(-values, kind="stable")[:count]
        return cls(int(n), [int(s) for s in sums], vectors[:, order].T.copy(), values[order], float(np.trace(centred) / (n * n)))

    @property
    def real(self) -> np.ndarray:
        """Which components have variance, beyond what rounding leaves of none."""
        return self.eigenvalues > len(self.sums) * np.finfo(float).eps * max(self.trace, 0)

    def explained(self) -> list[float]:
        return [max(0.0, float(e)) / self.trace if self.trace > 0 else 0.0 for e in self.eigenvalues]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Exact sums over the dimensions of (n x - S)^2: with y = x - floor(S / n) and r = S mod n, of (n y - r)^2."""
        base, rest = np.array([s // self.n for s in self.sums], np.int64), [s % self.n for s in self.sums]
        y = x - base
        most, width = max(1, int(np.abs(y).max(initial=0))), x.shape[1]
        kind = np.int64 if width * most * max(most, self.n) < 1 << 62 else object
        y = y.astype(kind)
        squares, mixed, fixed = (y * y).sum(1), (y * np.array(rest, kind)).sum(1), sum(r * r for r in rest)
        wide = np.int64 if 4 * width * (self.n * (most + 1)) ** 2 < 1 << 62 else object
        return squares.astype(wide) * self.n**2 - mixed.astype(wide) * (2 * self.n) + fixed

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates; columns without variance hold NaN."""
        base, rest = np.array([s // self.n for s in self.sums], np.int64), np.array([s % self.n / self.n for s in self.sums])
        out = ((x - base).astype(np.float64) - rest) @ self.vectors.T
        out[:, ~self.real] = np.nan
        out[:, self.real] /= np.sqrt(self.eigenvalues[self.real])
        return out


def _usable(rows: DataFrame, vector: str) -> DataFrame:
    single = isinstance(getattr(rows.schema[vector].dataType, "elementType", None), FloatType)
    exact = F.col(vector) if single else F.col(vector).cast("array<double>")  # single precision is in double precision exactly
    return rows.withColumn(vector, exact).filter(finite(F.col(vector)))


def _rate(name: str) -> Column:
    return F.struct(F.col("n").alias("n"), F.col(name).alias(name))


def fit(rows: DataFrame, vector: str = "embedding", count: int = COMPONENTS) -> Model | None:
    """The model of all usable vectors of the commonest length; None where there are none or that length is 0."""
    vectors = _usable(rows.select(vector), vector)
    width = vectors.groupBy(F.size(vector).alias("width")).agg(F.count("*").alias("n")).agg(F.max(_rate("width"))["width"]).first()[0]
    if not width:
        return None
    edge = width + 1
    upper = np.triu_indices(edge)

    def partial(batches):
        import pyarrow as pa

        hold("whitening")
        planes, seen = {}, 0

        def found():
            values = recombined(planes)[upper]
            for k, digits in _digits(values):
                some = np.flatnonzero(digits)
                yield pa.RecordBatch.from_arrays([pa.array((upper[0] * edge + upper[1])[some]), pa.array(np.full(len(some), k, np.int32)), pa.array(digits[some])], ["place", "digit", "value"])

        for batch in batches:
            if not batch.num_rows:
                continue
            x = integers(batch.column(0), width)
            add_products(planes, np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1))
            seen += len(x)
            if seen >= _FLUSH:
                yield from found()
                planes, seen = {}, 0
        if seen:
            yield from found()

    parts = vectors.filter(F.size(vector) == width).mapInArrow(partial, "place long, digit int, value long")
    sums = parts.groupBy("place", "digit").agg(F.sum("value").alias("value")).toArrow()  # (width + 1)^2 / 2 places
    gram = np.zeros(edge * edge, object)
    np.add.at(gram, sums.column("place").to_numpy(), sums.column("value").to_numpy().astype(object) << (_DIGIT * sums.column("digit").to_numpy().astype(object)))
    gram = gram.reshape(edge, edge)
    return Model.solve(np.triu(gram) + np.triu(gram, 1).T, count)


def transform(rows: DataFrame, model: Model, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key``, ``deviation`` (decimal) and ``whitened`` (one double a component) of every usable row."""
    width, columns = len(model.sums), len(model.eigenvalues)

    def projected(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        hold("whitening")
        exact = pa.decimal128(38, 0)
        for batch in batches:
            right = pc.equal(pc.list_value_length(batch.column(1)), width)
            known, other = batch.filter(right), batch.filter(pc.invert(right))
            if other.num_rows:
                yield pa.RecordBatch.from_arrays([other.column(0), pa.nulls(other.num_rows, exact), pa.nulls(other.num_rows, pa.list_(pa.float64()))], [key, "deviation", "whitened"])
            if known.num_rows:
                x = integers(known.column(1), width)
                squares, white = model.deviations(x), model.project(x).ravel()
                deviation = pa.array(squares).cast(exact) if squares.dtype == np.int64 else pa.array([Decimal(v) if v < 10**38 else None for v in squares], exact)
                ends = pa.array(np.arange(0, len(white) + 1, columns, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([known.column(0), deviation, pa.ListArray.from_arrays(ends, pa.array(white, mask=np.isnan(white)))], [key, "deviation", "whitened"])

    kind = rows.schema[key].dataType.simpleString()
    return _usable(rows.select(key, vector), vector).mapInArrow(projected, f"`{key}` {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(whitened: DataFrame, count: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` minus the identity; ``covar_pop`` centres as it goes."""
    if not count:
        return 0.0
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    got = whitened.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) for i, j in pairs]).first()
    return max((abs(v - (i == j)) for (i, j), v in zip(pairs, got, strict=True) if v is not None), default=0.0)


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", count: int = COMPONENTS) -> DataFrame:
    """One row a usable vector and component: ``key``, component, n, deviation (decimal), whitened, explained, identity_error."""
    kind = rows.schema[key].dataType.simpleString()
    model = fit(rows, vector, count)
    if model is None:
        return rows.sparkSession.createDataFrame([], f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    done = cut(transform(rows, model, vector, key))
    error, other = identity_error(done, len(model.eigenvalues)), fresh(rows.select(key), "_k")
    places = F.explode(F.array(*[F.struct(F.lit(k + 1).alias("component"), F.lit(e).alias("explained")) for k, e in enumerate(model.explained())]))
    return done.select("*", places.alias(other)).select(
        key, F.col(other)["component"].alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        F.get("whitened", F.col(other)["component"] - 1).alias("whitened"), F.col(other)["explained"].alias("explained"), F.lit(error).alias("identity_error"))
