"""Whitening and its solver, against numpy's eigenvalues and exact integer sums."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.llm import whitening
from tickforge.llm.bidiagonal import bidiagonalise, right_directions, squared_singular_values
from tickforge.llm.common import table
from tickforge.llm.queries import op12_whitening

from .conftest import TABLES


def _matrices():
    rng = np.random.default_rng(12)
    yield "plain", rng.standard_normal((40, 24))
    yield "graded", rng.standard_normal((60, 20)) * 10.0 ** -np.arange(20)
    yield "one", rng.standard_normal((5, 1))
    yield "two", rng.standard_normal((5, 2))
    yield "low rank", rng.standard_normal((50, 5)) @ rng.standard_normal((5, 16))
    yield "constant columns", np.hstack([rng.standard_normal((30, 6)), np.zeros((30, 3))])
    q, _ = np.linalg.qr(rng.standard_normal((50, 12)))
    yield "equal values", q * np.repeat([3.0, 2.0, 1.0], 4) @ np.linalg.qr(rng.standard_normal((12, 12)))[0]
    yield "near values", q * (1 + 1e-9 * np.arange(12)) @ np.linalg.qr(rng.standard_normal((12, 12)))[0]
    yield "identity", np.eye(9)


@pytest.mark.parametrize("name,a", list(_matrices()), ids=[n for n, _ in _matrices()])
def test_solver(name, a):
    r = np.linalg.qr(a, mode="r")
    square = np.zeros((a.shape[1], a.shape[1]))
    square[: len(r)] = r
    values, vectors = right_directions(square, a.shape[1])
    want = np.linalg.svd(a, compute_uv=False) ** 2
    want = np.pad(want, (0, a.shape[1] - len(want)))
    assert np.allclose(values, want, rtol=1e-10, atol=1e-13 * want[0])
    keep = values > 1e-24 * values[0] if name == "graded" else values > 1e-13 * values[0]
    v = vectors[:, keep]
    assert np.abs(v.T @ v - np.eye(keep.sum())).max() < 1e-9
    assert np.abs(a.T @ (a @ v) - v * values[keep]).max() < 1e-12 * want[0]


def test_bidiagonal_form_and_relative_accuracy():
    rng = np.random.default_rng(3)
    r = np.triu(rng.standard_normal((9, 9)))
    d, e, right = bidiagonalise(r)
    b = np.diag(d) + np.diag(e, 1)
    assert np.allclose(right.T @ right, np.eye(9)) and np.allclose(r.T @ r, right @ (b.T @ b) @ right.T)
    # Tiny values keep their leading digits: a graded matrix against its known product.
    d, e = 10.0 ** -np.arange(0, 16, 2), 10.0 ** -np.arange(1, 15, 2)
    got = squared_singular_values(d, e)
    assert math.isclose(np.prod(np.sqrt(got / got.max())) * np.sqrt(got.max()) ** 8, np.prod(d), rel_tol=1e-10)
    assert np.allclose(got[:3], np.linalg.svd(np.diag(d) + np.diag(e, 1), compute_uv=False)[:3] ** 2)


def _check(rows, got, components=32):
    """Against exact integers and numpy's eigenvectors."""
    x = np.array([[math.floor(64 * float(v)) + 1_000_000 for v in vec] for _, vec in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    apart = n * x - s
    centred = (apart / n).astype(float)
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, sum(values > 1e-10 * values[0]))
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    assert sorted(by) == sorted(i for i, _ in rows) and all(sorted(v) == list(range(1, k + 1)) for v in by.values())
    y = np.array([[by[i][c]["whitened"] for c in range(1, k + 1)] for i, _ in rows])
    want = centred @ vectors[:, :k] / np.sqrt(values[:k])
    sign = np.sign((y * want).sum(axis=0))
    assert np.abs(y - want * sign).max() < 1e-6
    for row, (i, _) in zip(apart, rows):
        assert by[i][1]["deviation"] == int((row * row).sum()) and by[i][1]["n"] == n
    for c in range(1, k + 1):
        assert math.isclose(by[rows[0][0]][c]["explained"], values[c - 1] / values.sum(), rel_tol=1e-6)
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, TABLES, "embeddings").collect()]
    _check(rows, op12_whitening(spark, TABLES).collect())


def test_cases(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.standard_normal(6).astype(np.float32)]) for i in range(40)]
    odd = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (102, [float("nan")] * 6), (103, [float("inf")] + [0.0] * 5), (104, []), (105, [1.0, 2.0])]
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame(rows + odd, schema).withColumns({"n": F.lit("x"), "component": F.lit(1), "vector": F.lit(None).cast("string")})
    _check(rows, whitening.whiten_table(df.repartition(7)).collect(), 6)
    again = whitening.whiten_table(spark.createDataFrame(rows + [rows[0], (None, rows[1][1])], schema), 2).collect()
    assert len(again) == 42 * 2 and sum(r["vec_id"] is None for r in again) == 2
    assert whitening.whiten_table(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten_table(spark.createDataFrame([rows[0]] * 3, schema)).count() == 0
    flat = whitening.whiten_table(spark.createDataFrame([(i, [float(i), 3.0]) for i in range(9)], schema)).collect()
    assert {r["component"] for r in flat} == {1}
    huge = spark.createDataFrame([(i, [1e38 * (i % 2), float(i)]) for i in range(5)], "vec_id long, embedding array<double>")
    assert whitening.whiten_table(huge).where("deviation is null").count() == 0
