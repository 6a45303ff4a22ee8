"""Closed-form fits against MLlib and their own optimality."""

import math
import random

from pyspark.sql import functions as F

from ledgerlake.operators import closed_form, models
from ledgerlake.operators.closed_form import fit_linear, fit_logistic, linear_predictions, logistic_predictions, solve

INPUTS = ("a", "b", "c", "d", "e")


def _rows(n, seed, classes=False):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x = [rng.randrange(0, 9), round(rng.uniform(10, 90_000), 2), round(rng.uniform(0, 4), 6), rng.randrange(2), rng.randrange(-50, 2500)]
        z = 0.3 * x[0] - 2e-5 * x[1] + x[2] - x[3] + 1e-4 * x[4]
        y = float(rng.random() < 1 / (1 + math.exp(-z))) if classes else z + rng.gauss(0, 1)
        out.append((f"t{i}", y, *map(float, x)))
    return out


def _frame(spark, rows):
    return spark.createDataFrame(rows, "TransactionID string, label double, " + ", ".join(f"{c} double" for c in INPUTS)).persist()


def test_linear_fit_agrees_with_mllib(spark):
    df = _frame(spark, [(r[0], round(r[1], 6), *r[2:]) for r in _rows(800, 1)] + [("null", 1.0, None, 1.0, 1.0, 1.0, 1.0), ("nan", 1.0, float("nan"), 1.0, 1.0, 1.0, 1.0)])
    fit = fit_linear(df, INPUTS)
    other = models.fit_regressor(df, INPUTS).stages[-1]
    for mine, theirs in zip([*fit.coefficients, fit.intercept], [*other.coefficients.toArray(), other.intercept]):
        assert abs(mine - theirs) <= 1e-6 * max(1, abs(theirs))
    got = {r.TransactionID: r.PredictedRiskScore for r in linear_predictions(fit, df).collect()}
    assert got["null"] is None and got["nan"] is None and len(got) == 802
    assert fit_linear(df.repartition(13), INPUTS) == fit                    # the order of the rows doesn't matter


def test_logistic_fit_agrees_with_mllib(spark):
    df = _frame(spark, _rows(1500, 2, classes=True))
    fit = fit_logistic(df, INPUTS)
    assert fit.shift < 1e-9
    other = models.fit_classifier(df, INPUTS).stages[-1]
    for mine, theirs in zip([*fit.coefficients, fit.intercept], [*other.coefficients.toArray(), other.intercept]):
        assert abs(mine - theirs) <= 1e-4 * max(1e-2, abs(theirs))          # MLlib stops at its own tolerance
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-closed_form.score(fit)))
    slopes = df.agg(*(F.sum((p - F.col("label")) * F.col(c)) for c in INPUTS), F.sum(p - F.col("label"))).first()
    for s, w in zip(slopes, [*fit.coefficients, 0.0]):
        assert abs(s + w) < 1e-4
    preds = logistic_predictions(fit, df).collect()
    assert all(r.Predicted == int(r.PredictedProb > 0.5) for r in preds if abs(r.PredictedProb - 0.5) > 1e-3)


def test_constant_and_repeated_inputs(spark):
    rows = [(r[0], round(r[1], 6), r[2], r[3], 7.0, r[2], r[6]) for r in _rows(200, 3)]
    fit = fit_linear(_frame(spark, rows), INPUTS)
    assert fit.coefficients[2] == 0.0 and fit.coefficients[3] == 0.0        # constant; a copy of an earlier input
    assert solve([[4.0, 2.0], [2.0, 3.0]], [2.0, 1.0], [4.0, 3.0]) == [0.5, 0.0]


def test_no_usable_rows(spark):
    df = _frame(spark, [("x", None, *[1.0] * 5), ("y", 1.0, None, *[1.0] * 4)])
    assert fit_linear(df, INPUTS).coefficients == [0.0] * 5 and fit_logistic(df, INPUTS).intercept == 0.0
