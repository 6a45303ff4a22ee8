"""Whitening against a dense eigendecomposition."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm.whitening import fit, offsets, whiten


def frame(spark, rows):
    return (spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
            .withColumn("id", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("y", F.lit(None).cast("string")))


def brute(rows):
    """ids, x as Python ints, eigenvalues (falling) and eigenvectors of the covariance."""
    ok = [(i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]) for i, v in rows
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in ok], float)
    centred = x - x.mean(axis=0)
    e, u = np.linalg.eigh(centred.T @ centred / len(x))
    return ok, centred, e[::-1], u[:, ::-1]


def check(spark, rows, count=8):
    ok, centred, e, u = brute(rows)
    found = whiten(frame(spark, rows)).collect()
    count = min(count, int((e > 1e-12 * e[0]).sum()))
    assert len(found) == len(ok) * count
    n, sums = len(ok), [sum(v[k] for _, v in ok) for k in range(len(ok[0][1]))]
    dev = sorted((str(i), sum((n * a - s) ** 2 for a, s in zip(v, sums))) for i, v in ok)
    for k in range(count):
        own = [r for r in found if r.component == k + 1]
        assert sorted((str(r.vec_id), int(r.deviation)) for r in own) == dev
        assert {r.n for r in own} == {n}
        assert all(abs(r.explained - e[k] / e.sum()) <= 1e-10 for r in own)
        assert all(0 <= r.identity_error < 1e-9 for r in own)
        got, want = (sorted(abs(x) for x in v) for v in ([r.whitened for r in own], centred @ u[:, k] / math.sqrt(e[k])))
        if np.diff(e[max(k - 1, 0) : k + 2]).max() < -1e-6 * e[0]:  # an eigenvalue of its own
            assert np.allclose(got, want, atol=1e-8)


def test_against_eigenvectors(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1 + k / 3) for k in range(12)]) for i in range(90)]
    rows += [(None, rows[0][1]), (5, rows[1][1]), (900, None), (901, [None] * 12), (902, [float("nan")] + [0.0] * 11),
             (903, [float("inf")] * 12)]
    check(spark, rows)


def test_few_dimensions_and_low_rank(spark):
    rng = random.Random(4)
    check(spark, [(i, [rng.gauss(0, 1), rng.gauss(0, 2), 0.5]) for i in range(40)])  # one constant dimension
    base = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(2)]
    rows = [(i, base[i % 2]) for i in range(30)]  # one direction
    check(spark, rows)


def test_equal_eigenvalues(spark):
    """Twelve directions of the same variance: all of the wanted ones are found."""
    rows = [(2 * k + s, [(1.0 if s else -1.0) if j == k else 0.0 for j in range(12)]) for k in range(12) for s in (0, 1)]
    found = whiten(frame(spark, rows)).collect()
    assert len(found) == 24 * 8 and max(r.identity_error for r in found) < 1e-9
    assert {round(r.explained, 9) for r in found} == {round(1 / 12, 9)}


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])], [(1, None)]):
        assert whiten(frame(spark, rows)).collect() == []


def test_undefined_inputs_raise(spark):
    with pytest.raises(ValueError):
        whiten(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])]))
    with pytest.raises(OverflowError):
        whiten(frame(spark, [(1, [1e30]), (2, [1.0])]))


def test_steps_are_bidiagonal(spark):
    """The fit takes no more steps than dimensions and its components are orthonormal."""
    rng = random.Random(5)
    rows = frame(spark, [(i, [rng.gauss(0, 4.0 / (k + 1)) for k in range(10)]) for i in range(60)])
    w = fit(offsets(rows, "vec_id", "embedding"), most=3)
    assert 3 < w.steps <= 10 and np.allclose(w.components.T @ w.components, np.eye(3), atol=1e-12)
