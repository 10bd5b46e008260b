"""Whitening against a dense eigendecomposition, the qd solver against numpy, and odd rows."""

import math

import numpy as np
import pytest

from tidemark.llm import queries, whitening
from tidemark.llm.bidiagonal import bidiagonalise, leading, qd_values, unreflect
from tidemark.llm.shipping import ship

SCHEMA = "vec_id long, embedding array<double>"


def wanted(vectors, components=4, scale=256):
    """By plain integers and numpy's dense solver."""
    x = [[math.floor(scale * c) for c in v] for v in vectors]
    distinct = sorted(set(map(tuple, x)))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[c - s / n for c, s in zip(v, sums)] for v in distinct])
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    rows = (np.array(x) - np.array(sums) / n) @ directions[:, :components]
    return n, deviations, values, rows


def compare(found, vectors, components=4):
    n, deviations, values, rows = wanted(vectors, components)
    for c in range(components):
        mine = sorted((r for r in found if r.component == c + 1), key=lambda r: r.vec_id)
        assert [r.n for r in mine] == [n] * len(vectors) and [r.deviation for r in mine] == deviations
        assert mine[0].explained == pytest.approx(values[c] / values.sum(), rel=1e-9)
        whitened, expected = np.array([r.whitened for r in mine]), rows[:, c] / np.sqrt(values[c])
        assert min(np.abs(whitened - expected).max(), np.abs(whitened + expected).max()) < 1e-8
        assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-9


@pytest.mark.parametrize("shape", [(5, 5), (40, 7), (3, 8), (64, 64), (6, 1)])
def test_solver_equals_numpy(shape):
    rng = np.random.default_rng(4)
    a = rng.normal(size=shape) * np.logspace(0, -6, shape[1])
    r = np.zeros((shape[1], shape[1]))
    triangle = np.linalg.qr(a, mode="r")
    r[: len(triangle)] = triangle
    u, s, v = np.linalg.svd(a)
    values, vectors = leading(r, shape[1])
    assert np.allclose(values[: len(s)], s, rtol=1e-9, atol=1e-14 * s[0])
    assert np.allclose(vectors.T @ vectors, np.eye(shape[1]), atol=1e-6)
    for i in range(min(3, len(s))):
        assert np.abs(np.abs(vectors[:, i] @ v[i]) - 1) < 1e-10


def test_reflections_and_small_values():
    rng = np.random.default_rng(5)
    a = np.triu(rng.normal(size=(9, 9)))
    diagonal, above, right = bidiagonalise(a)
    p = np.column_stack([unreflect(x, right) for x in np.eye(9)])
    b = np.diag(diagonal) + np.diag(above, 1)
    assert np.allclose(b.T @ b, p.T @ a.T @ a @ p)
    # a graded bidiagonal: even its smallest value keeps its digits
    q, e = np.logspace(0, -40, 12), np.logspace(-1, -41, 11)
    found = qd_values(q, e)
    assert np.prod(found / np.sort(q)[::-1]) == pytest.approx(1, rel=1e-10)  # the determinant
    assert (found > 0).all()


@pytest.mark.parametrize("triangle", [np.eye(6), np.zeros((4, 4)), np.ones((5, 5)), np.diag([3.0, 3, 3, 0, 0]), np.diag([2.0, 2, 1, 1]) + np.diag([1e-9] * 3, 1)])
def test_equal_and_zero_values(triangle):
    values, vectors = leading(triangle, 4)
    assert np.allclose(values, np.linalg.svd(triangle)[1][:4], atol=1e-8)
    assert np.allclose(vectors.T @ vectors, np.eye(4), atol=1e-8)


def test_query_equals_dense_solver(spark):
    sf = "/root/testdata/sf0.001"
    vectors = {r.vec_id: [float(np.float32(c)) for c in r.embedding] for r in queries.table(spark, sf, "embeddings").collect()}
    compare(queries.QUERIES["op11_whitening"](spark, sf).collect(), [vectors[k] for k in sorted(vectors)])


def test_odd_rows_and_copies(spark):
    rng = np.random.default_rng(6)
    good = [*rng.normal(size=(30, 5)).tolist(), *[[0.5, -0.25, 1.0, 0.0, 3.0]] * 400, [1e3] * 5]
    bad = [None, [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf")] + [0.0] * 4]
    rows = [*enumerate(good), *((1000 + i, v) for i, v in enumerate(bad))]
    frame = ship(spark).createDataFrame(rows, SCHEMA).repartition(7)
    found = whitening.whiten(frame, ["vec_id"]).collect()
    assert len(found) == 4 * len(good) and found[0].n == 32
    compare(found, good)


def test_many_tasks_reduce_to_one_triangle(spark):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(300, 3)).tolist()
    frame = ship(spark).createDataFrame(list(enumerate(vectors)), SCHEMA)
    whole = whitening.whiten(frame.repartition(1), ["vec_id"], components=3).collect()
    compare(whole, vectors, 3)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        compare(whitening.whiten(frame.repartition(5), ["vec_id"], components=3).collect(), vectors, 3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_short_vectors_large_entries_and_names(spark):
    rows = [(1, [1.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, []), (5, [1e300, -1e300])]
    frame = ship(spark).createDataFrame(rows, "n long, embedding array<double>")
    found = whitening.whiten(frame, ["n"]).collect()
    assert len(found) == 2 * len(rows) and found[0].asDict().keys() == {"n", "component", "n_", "deviation", "whitened", "explained", "identity_error"}
    assert {r.n_ for r in found} == {4}  # [1] and [1, 0] are one vector
    assert all(r.deviation is None for r in found if r.n == 5)  # beyond a long
    assert found[0].whitened == found[2].whitened


def test_without_variance_and_empty(spark):
    ship(spark)
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA), ["vec_id"]).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 4
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], SCHEMA), ["vec_id"]).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in flat) and flat[0].identity_error < 1e-9
    for rows in ([], [(1, None)], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA), ["vec_id"]).count() == 0
