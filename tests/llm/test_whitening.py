"""Whitening against a plain eigendecomposition of the exact covariance."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import whitening

SCHEMA = "vec_id long, embedding array<double>"


def run(spark, rows, **options):
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA), **options).collect()
    return sorted(found, key=lambda r: (r.vec_id, r.component))


def brute(vectors, k):
    """Deviations, places on the first k axes, shares, over the distinct vectors of whole numbers."""
    x = np.floor(256 * np.array(vectors, float)).astype(int)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = (fit * n - s) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1][:, :k]
    places = ((x * n - s) / n) @ axes / np.sqrt(values[:k])
    return n, ((n * x - s) ** 2).sum(1), places, values[:k] / values.sum()


def check(spark, vectors, k=4, dims=None):
    found = run(spark, [(i, list(map(float, v))) for i, v in enumerate(vectors)])
    n, deviation, places, shares = brute(vectors, k)
    assert len(found) == len(vectors) * k
    got = np.array([r.whitened for r in found]).reshape(-1, k)
    got *= np.sign((got * places).sum(0))
    assert np.allclose(got, places, atol=1e-7)
    assert [int(r.deviation) for r in found[::k]] == deviation.tolist()
    assert np.allclose([r.explained for r in found[:k]], shares, rtol=1e-9)
    assert found[0].n == n and found[0].identity_error < 1e-8


def test_equals_eigendecomposition(spark):
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(300, 12)) * np.linspace(3, 1, 12)
    check(spark, np.r_[vectors, vectors[:40]])


def test_dependent_and_constant_columns(spark):
    draw = np.random.default_rng(2)
    free = np.floor(256 * draw.normal(size=(200, 5)) * [9, 7, 5, 3, 1]) / 256
    vectors = np.c_[free[:, :2], np.full(200, 4.0), free[:, 2:], free[:, 0] + free[:, 1], np.zeros(200)]
    check(spark, vectors)


def test_ill_conditioned_columns(spark):
    """Nearly equal columns beside a far mean: the Gram matrix alone would lose the small axes."""
    draw = np.random.default_rng(3)
    base = np.floor(2.0**30 * draw.normal(size=(200, 1)))
    small = draw.integers(-40, 40, size=(200, 3)) / 256.0
    vectors = np.c_[base + small[:, :1], base + small[:, 1:2], small[:, 2:]] + 2.0**20
    found = run(spark, [(i, list(v)) for i, v in enumerate(vectors.tolist())], components=3)
    assert len(found) == 600 and found[0].identity_error < 1e-4
    x = np.floor(256 * vectors)
    centred = x - x.mean(0)
    values = np.linalg.svd(centred)[1] ** 2
    assert np.allclose([r.explained for r in found[:3]], values / values.sum(), rtol=1e-4)


def test_exact_sizes_of_large_numbers():
    v = np.array([[2**61, -(2**60), 7], [-3, 2**31, -(2**31) - 1]], np.int64)
    assert whitening.squared_sizes(v) == [sum(int(c) ** 2 for c in row) for row in v]
    assert whitening.squared_sizes(v.astype(object)) == whitening.squared_sizes(v)
    x = np.array([[2**50, 5]], np.int64)
    assert whitening.deviations(x, 2**20, [1, 2], 2**50).tolist() == [[2**70 - 1, 5 * 2**20 - 2]]


def test_unusable_and_ragged_vectors(spark):
    rows = [
        (1, [1.0, 2.0, 0.5]),
        (2, None),
        (3, [1.0, None, 0.0]),
        (4, [float("nan"), 0.0, 0.0]),
        (5, [float("inf"), 0.0, 0.0]),
        (None, [9.0, 9.0, 9.0]),
        (6, [4.0]),
        (6, [4.0, 0.0, 0.0]),
        (7, []),
        (1, [1.0, 2.0, 0.5]),
        (8, [-0.0, 3.0, 1.0]),
    ]
    found = run(spark, rows)
    # Ids 1 and 6 occur twice; the vectors of 6 are one.
    assert {r.vec_id for r in found} == {1, 6, 7, 8} and found[0].n == 4
    assert len([r for r in found if r.component == 1]) == 6
    assert len({r.whitened for r in found if r.vec_id == 6 and r.component == 1}) == 1


def test_empty_single_and_clashing(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(20)]
    table = spark.createDataFrame(rows, SCHEMA)
    wide = table.select("*", F.lit(1).alias("x"), F.lit(2).alias("VEC_ID"), F.lit(3).alias("n"))
    assert whitening.whiten(wide).count() == whitening.whiten(table).count() == 40


def test_too_many_dimensions_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MOST_DIMS", 2)
    with pytest.raises(ValueError, match="at most 2"):
        run(spark, [(1, [1.0, 2.0, 3.0])])
