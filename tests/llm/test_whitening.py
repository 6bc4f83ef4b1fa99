import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evidora.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(vectors):
    """n, exact squared deviations, coordinates up to sign and shares of the trace, from Python integers and fractions."""
    x = [[math.floor(Fraction(c) * 1024) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = [[n * c - s for c, s in zip(v, sums, strict=True)] for v in x]
    cov = np.array([[float(Fraction(sum(v[i] * v[j] for v in centred), n**3)) for j in range(len(sums))] for i in range(len(sums))])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    exact = np.array([[float(Fraction(c, n)) for c in v] for v in centred])
    return n, [sum(c * c for c in v) for v in centred], exact @ axes / np.sqrt(values), values / np.trace(cov)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def check(spark, vectors, tolerance=1e-9):
    got = whitening.whiten(table(spark, [(k, v, 0) for k, v in enumerate(vectors)])).collect()
    n, deviations, white, explained = brute(vectors)
    assert len(got) == n * white.shape[1]
    for r in got:
        assert (r.n, int(r.deviation)) == (n, deviations[r.vec_id])
        assert abs(abs(r.whitened) - abs(white[r.vec_id, r.component - 1])) < tolerance * max(1, abs(r.whitened))
        assert math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-9)
        assert r.identity_error < 1e-9
    return got


def test_same_as_fractions(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(120, 11)) * np.linspace(0.2, 3, 11)).tolist()
    got = check(spark, vectors)
    first = sorted((r.vec_id, r.whitened) for r in got if r.component == 1)
    assert abs(np.mean([w for _, w in first])) < 1e-12  # one sign for all rows


def test_fewer_dimensions_than_components(spark):
    assert {r.component for r in check(spark, np.random.default_rng(4).normal(size=(40, 3)).tolist())} == {1, 2, 3}


def test_sums_beyond_long_stay_exact(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(60, 9)) * 3e9).tolist()  # x of some 42 bits: sums of squares of more than 63
    check(spark, vectors)


def test_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = rng.normal(size=(30, 9)).tolist()
    rows = [(k, v, None) for k, v in enumerate(good)]
    odd = [(100, None, 1), (101, [None] * 9, 1), (102, [math.nan] * 9, 1), (103, [math.inf] + [0.0] * 8, 1), (104, [1.0, 2.0], 1), (105, [], 1), (None, good[0], 1)]
    got = whitening.whiten(table(spark, rows + odd)).collect()
    assert len(got) == 8 * 33 and {r.n for r in got} == {31}
    others = [r for r in got if r.vec_id in (104, 105)]
    assert len(others) == 16 and all(r.deviation is None and r.whitened is None for r in others)
    of = lambda i: sorted((r.component, r.deviation, round(r.whitened, 9)) for r in got if r.vec_id == i)
    assert of(None) == of(0)
    n, deviations, *_ = brute([*good, good[0]])
    assert [int(x[1]) for x in of(0)] == [deviations[0]] * 8


@pytest.mark.parametrize("vectors", [[[1.5, 2.0, -3.0]], [[1.5, 2.0]] * 4, [[0.0, 0.0]] * 3])
def test_no_variance(spark, vectors):
    got = whitening.whiten(table(spark, [(k, v, 0) for k, v in enumerate(vectors)])).collect()
    assert len(got) == len(vectors) * len(vectors[0])
    assert all(r.whitened is None and r.deviation == 0 and r.explained == 0 and r.identity_error == 0 for r in got)


def test_one_direction_only(spark):
    got = whitening.whiten(table(spark, [(k, [float(k), 2.0 * k, 5.0], 0) for k in range(9)])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got) and {round(r.explained, 9) for r in got} == {1.0, 0.0}
    assert all(r.identity_error < 1e-9 for r in got)


def test_huge_components_do_not_crash(spark):
    got = whitening.whiten(table(spark, [(k, [1e308 * (-1) ** k, float(k)], 0) for k in range(6)])).collect()
    assert len(got) == 12 and {r.n for r in got} == {6}


def test_empty_and_clashing_names(spark):
    empty = whitening.whiten(table(spark, []))
    assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(table(spark, [(1, [], 0), (2, None, 0)])).collect() == []
    from pyspark.sql import functions as F

    vectors = table(spark, [(k, [float(k % 5), float(k % 3)], 0) for k in range(12)])
    wide = vectors.select("*", *[F.lit(7).alias(c) for c in ("component", "n", "deviation", "whitened", "explained", "identity_error", "place", "digit", "value", "width", "_k")])
    one, other = (sorted((r.vec_id, r.component, r.deviation, round(abs(r.whitened), 9)) for r in whitening.whiten(d).collect()) for d in (wide, vectors))
    assert one == other


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**61), 2**61), min_size=3, max_size=3), min_size=1, max_size=9))
def test_limbs_give_exact_products(rows):
    x, planes = np.array(rows, np.int64), {}
    whitening.add_products(planes, x)
    exact = x.astype(object)
    got = whitening.recombined(planes) if planes else np.zeros((3, 3), object)
    assert (got == exact.T @ exact).all()
    again = sum((d.astype(object) << (32 * k) for k, d in whitening._digits(got)), np.zeros((3, 3), object))
    assert (again == got).all()
