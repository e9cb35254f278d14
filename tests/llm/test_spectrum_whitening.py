"""Whitening: eigenpairs against a plain decomposition, exact integer figures, defined cases."""

import math

import numpy as np
import pytest

from response_ledger.llm import spectrum_whitening as sw


def plain(vectors):
    """(deviations, whitened by component, explained, covariance's eigenvalues) by brute force."""
    x = [[math.floor(64 * c) + 1000000 for c in one] for one in vectors]
    fit = sorted({tuple(one) for one in x})
    n, total = len(fit), [sum(column) for column in zip(*fit)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(one, total)) for one in x]
    centre = np.array([[(n * a - s) / n for a, s in zip(one, total)] for one in fit])
    values, turn = np.linalg.eigh(centre.T @ centre / n)
    values, turn = values[::-1], turn[:, ::-1]
    rows = np.array([[(n * a - s) / n for a, s in zip(one, total)] for one in x])
    return n, deviations, rows @ turn / np.sqrt(np.maximum(values, 1e-300)), values / values.sum()


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 9, 40):
        a = rng.normal(size=(size, size))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in [-100.0, 100.0, 0.0, *((values[1:] + values[:-1]) / 2)]:
            assert sw.inertia_above(a, shift) == (values > shift).sum()
    assert sw.inertia_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert sw.inertia_above(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(30, 1, 24), [5.0] * 24, [9, 9, 9, 4, 4, 1, 1, 1], [1e8, 1, 1 - 1e-9, 1e-6],
        [1, 1 - 1e-13, 0.5, 0, 0], [3.0], [2.0, 0.0],
    ],
)
def test_leading_pairs(values):
    values = np.array(values, float)
    turn = np.linalg.qr(np.random.default_rng(2).normal(size=(len(values), len(values))))[0]
    matrix = (turn * values) @ turn.T
    found, vectors = sw.Spectrum(matrix).leading(16)
    expected = np.sort(values[values > 0])[::-1][:16]
    assert len(found) == len(expected) and np.allclose(found, expected, rtol=0, atol=1e-13 * len(values) * values.max())
    assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-12
    assert np.abs(matrix @ vectors.T - vectors.T * found).max() < 1e-12 * values.max()


def test_whitening_against_a_plain_decomposition(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(700, 20)) * np.linspace(2, 0.3, 20)).astype(np.float32)
    vectors[600:] = vectors[0]
    table = spark.createDataFrame(
        [(i, one.tolist(), 7) for i, one in enumerate(vectors)], "vec_id long, embedding array<float>, n int"
    ).repartition(5)
    rows = sw.whiten(table).collect()
    n, deviations, whitened, explained = plain(vectors.astype(float).tolist())
    assert len(rows) == 700 * 16 and {row["n"] for row in rows} == {n}
    mine = np.zeros((700, 16))
    for row in rows:
        mine[row["vec_id"], row["component"] - 1] = row["whitened"]
        assert row["deviation"] == deviations[row["vec_id"]]
        assert abs(row["explained"] / explained[row["component"] - 1] - 1) < 1e-10
        assert row["identity_error"] < 1e-10
    sign = np.sign((mine * whitened[:, :16]).sum(0))
    assert np.abs(mine - whitened[:, :16] * sign).max() < 1e-9
    assert len({row["identity_error"] for row in rows}) == 1


def test_defined_cases(spark):
    rows = [
        (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("-inf"), 1.0]), (5, []), (6, [2.0]),
        (7, [0.0, 0.0]), (7, [1.0, 0.5]), (None, [-1.0, 0.25]), (8, [0.0, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sw.whiten(table).collect()
    # [] and the lone [2.0] have no variance; the others are rows of one fit of three vectors.
    assert sorted(str(row["vec_id"]) for row in found) == sorted(["7", "7", "8", "None"] * 2)
    assert {row["n"] for row in found} == {3}
    assert sw.whiten(table.limit(0)).collect() == []
    assert sw.whiten(table.where("vec_id = 6")).collect() == []


def test_figures_beyond_a_long(spark):
    rows = [(i, [1e30 * (i - 1), float(i)]) for i in range(3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {row["vec_id"]: row for row in sw.whiten(table).collect() if row["component"] == 1}
    # The middle one: n * x - S is (2 * 10**6 - 2**62 + 2**62 ...) exactly zero by symmetry.
    assert found[1]["deviation"] == 0 and found[0]["deviation"] is None
