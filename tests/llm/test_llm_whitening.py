"""Whitening against numpy and exact integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotlens.llm import whitening
from lotlens.llm.queries import op12_whitening

SF = "/root/testdata/sf0.001"
VEC = "vec_id long, embedding array<float>"


def plain_integers(rows):
    kept = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    return [(k, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for k, v in kept]


def assert_whitened(rows, got, components=16):
    """Against numpy's solver; the sign of a component is free, but the same in all rows."""
    x = plain_integers(rows)
    fit = np.array(sorted({tuple(v) for _, v in x}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    y = (fit * n - sums).astype(float) / n
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors.T[::-1][:components]
    real = values > len(v) * 1e-15 * values[0]
    values, vectors = values[real], vectors[real]
    by_row = {}
    for r in got:
        by_row.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    assert len(got) == len(x) * len(values)
    signs = {}
    for key, ints in x:
        deviation = sum((n * c - int(s)) ** 2 for c, s in zip(ints, sums))
        found = by_row[(key, deviation if deviation < 2**63 else None)]
        assert sorted(found) == list(range(1, len(values) + 1))
        centred = np.array([float(n * c - int(s)) / n for c, s in zip(ints, sums)])
        for k in range(len(values)):
            wanted = vectors[k] @ centred / np.sqrt(values[k])
            one = found[k + 1][0]
            assert one["n"] == n and one["explained"] == pytest.approx(values[k] / np.trace(v), rel=1e-4)
            assert one["identity_error"] <= 1e-4
            if abs(wanted) > 1e-6:
                sign = signs.setdefault(k, np.sign(wanted) * np.sign(one["whitened"]))
                assert one["whitened"] * sign == pytest.approx(wanted, rel=1e-6, abs=1e-7)


def test_query_equals_numpy(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert_whitened(rows, op12_whitening(spark, SF).collect())


def test_odd_vectors(spark):
    state = random.Random(2)
    rows = [(i, [state.gauss(0, 3) for _ in range(5)]) for i in range(60)]
    odd = [
        (100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [float("nan")] * 5),
        (104, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (None, [0.5] * 5), (None, [0.25] * 5),
    ]
    copies = [(7, rows[7][1])] + [(200 + i, rows[3][1]) for i in range(20)]
    df = spark.createDataFrame(rows + odd + copies, VEC).withColumns({"_key": F.lit(1), "_x": F.lit(2), "n": F.lit(3)})
    got = whitening.whiten(df, "vec_id", "embedding").collect()
    assert_whitened([r for r in rows + odd + copies if r[0] != 105], got)
    assert {100, 101, 102, 103, 104, 105}.isdisjoint({r["vec_id"] for r in got})


def test_no_variance_and_no_rows(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whitening.whiten(spark.createDataFrame(rows, VEC), "vec_id", "embedding")
        assert got.columns == columns and got.collect() == []
    # two dimensions are one, one is constant
    rows = [(i, [float(i), float(i), 7.0, float(i % 3)]) for i in range(30)]
    got = whitening.whiten(spark.createDataFrame(rows, VEC), "vec_id", "embedding").collect()
    assert {r["component"] for r in got} == {1, 2} and max(r["identity_error"] for r in got) < 1e-9


def test_large_entries(spark):
    rows = [(i, [float(i) * 3e12, 1.0, float(i % 2)]) for i in range(50)] + [(50, [3e38, 0.0, 0.0])]
    got = whitening.whiten(spark.createDataFrame(rows, VEC), "vec_id", "embedding").collect()
    assert {r["deviation"] for r in got} == {None} and len({r["vec_id"] for r in got}) == 51


def matrices():
    state = np.random.default_rng(5)
    q, _ = np.linalg.qr(state.standard_normal((40, 40)))
    yield "spread", q @ np.diag(np.geomspace(1e6, 1e-6, 40)) @ q.T
    yield "equal", q @ np.diag([5.0] * 20 + [1.0] * 20) @ q.T
    yield "near", q @ np.diag(1 + 1e-13 * np.arange(40)) @ q.T
    yield "identity", np.eye(30)
    yield "blocks", np.kron(np.eye(8), np.array([[2.0, 1, 0], [1, 2, 1], [0, 1, 2]]))
    yield "low rank", q[:, :3] @ q[:, :3].T
    yield "one", np.array([[3.0]])
    yield "two", np.array([[1.0, 2.0], [2.0, -5.0]])
    w = np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    yield "pairs of close eigenvalues", w


@pytest.mark.parametrize("name,matrix", matrices(), ids=lambda x: x if isinstance(x, str) else "")
def test_eigenpairs(name, matrix):
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.leading_pairs(matrix, 16)
    wanted = np.linalg.eigvalsh(matrix)[::-1][:16]
    norm = np.abs(wanted).max()
    assert np.allclose(values, wanted, rtol=0, atol=1e-12 * norm)
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-11
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() < 1e-11 * norm


def test_sturm_counts():
    state = np.random.default_rng(8)
    diagonal, off = state.standard_normal(12), state.standard_normal(11)
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    x = np.linspace(-5, 5, 101)
    assert whitening.below(diagonal, off, x).tolist() == [(values < c).sum() for c in x]
