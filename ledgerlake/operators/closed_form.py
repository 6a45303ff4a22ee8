"""Linear and logistic fits whose every number is an aggregate and a short elimination.

The linear fit needs one pass: counts, sums and sums of products of all inputs
(normal equations).  The logistic fit is Newton's method: one such pass per step,
with the rows weighted by ``p (1 - p)``.  The systems have one row per input, so solving them
is a few dozen operations on the driver, in a fixed order that SQL can repeat
(``plans.oracle`` does).

Inputs are used with six decimals.  The linear fit sums their products as decimals, so
its sums don't depend on the order of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FEATURE_COLUMNS

#: A pivot below this share of its diagonal element counts as zero: the input is constant or a
#: combination of earlier ones, and its coefficient is 0.
ZERO_PIVOT = 1e-12
#: Newton steps of a logistic fit; the last ones change nothing any more.
NEWTON_STEPS = 12

EXACT = "decimal(18,6)"


@dataclass
class Fit:
    """Coefficients by input and the intercept; ``shift`` is the size of the last Newton step (0 for a linear fit)."""

    inputs: tuple[str, ...]
    coefficients: list[float]
    intercept: float
    shift: float = 0.0


def usable(inputs: Sequence[str]) -> Column:
    """Rows that a fit can use: a label and all inputs (no NULL, no NaN)."""
    out = F.col("label").isNotNull()
    for c in inputs:
        out = out & F.col(c).isNotNull() & ~F.isnan(c)
    return out


def solve(a: list[list[float]], b: list[float], diagonal: Sequence[float]) -> list[float]:
    """Gaussian elimination of a symmetric positive system without exchanging rows."""
    n = len(b)
    a, b = [list(row) for row in a], list(b)
    sound = []
    for k in range(n):
        sound.append(a[k][k] > ZERO_PIVOT * diagonal[k])
        for i in range(k + 1, n):
            f = a[i][k] / a[k][k] if sound[k] else 0.0
            for j in range(k, n):
                a[i][j] = a[i][j] - f * a[k][j]
            b[i] = b[i] - f * b[k]
    x = [0.0] * n
    for k in range(n - 1, -1, -1):
        rest = b[k]
        for j in range(k + 1, n):
            rest = rest - a[k][j] * x[j]
        x[k] = rest / a[k][k] if sound[k] else 0.0
    return x


def fit_linear(rows: DataFrame, inputs: Sequence[str] = FEATURE_COLUMNS) -> Fit:
    """Ordinary least squares of ``label`` on ``inputs`` with intercept: one aggregate over ``rows``.

    No usable row gives zeros; an input that is constant or a combination of
    earlier ones gets 0.
    """
    names = [*inputs, "label"]
    x = [F.col(c).cast(EXACT) for c in names]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names) if i < len(inputs) else i)]
    sums = rows.where(usable(inputs)).agg(F.count(F.lit(1)), *(F.sum(c) for c in x), *(F.sum(x[i] * x[j]) for i, j in pairs)).first()
    n = sums[0]
    if not n:
        return Fit(tuple(inputs), [0.0] * len(inputs), 0.0)
    mean = [float(s) / n for s in sums[1 : 1 + len(names)]]
    cov = {p: float(s) / n - mean[p[0]] * mean[p[1]] for p, s in zip(pairs, sums[1 + len(names) :])}
    k = len(inputs)
    a = [[cov[min(i, j), max(i, j)] for j in range(k)] for i in range(k)]
    w = solve(a, [cov[i, k] for i in range(k)], [a[i][i] for i in range(k)])
    intercept = mean[k]
    for i in range(k):
        intercept = intercept - w[i] * mean[i]
    return Fit(tuple(inputs), w, intercept)


def score(fit: Fit) -> Column:
    """Intercept plus coefficient times input; NULL where an input is missing."""
    z = F.lit(fit.intercept)
    for c, w in zip(fit.inputs, fit.coefficients):
        z = z + F.lit(w) * F.col(c).cast(EXACT).cast("double")
    return z


def fit_logistic(rows: DataFrame, inputs: Sequence[str] = FEATURE_COLUMNS, c: float = 1.0, steps: int = NEWTON_STEPS) -> Fit:
    """Optimum of ``0.5 |w|^2 + C * sum(logloss)`` by ``steps`` Newton steps from zero, each one aggregate over ``rows``.

    ``rows`` should be a written table: every step reads it.  The intercept isn't
    penalised.  ``shift`` of the result tells whether the steps were enough.
    """
    rows = rows.where(usable(inputs))
    k = len(inputs)
    fit = Fit(tuple(inputs), [0.0] * k, 0.0)
    x = [F.lit(1.0), *(F.col(i).cast(EXACT).cast("double") for i in inputs)]
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    for _ in range(steps):
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-score(fit)))
        own = rows.select(*(v.alias(f"x{i}") for i, v in enumerate(x)), (p - F.col("label")).alias("r"), (p * (F.lit(1.0) - p)).alias("v"))
        sums = own.agg(*(F.sum(F.col("r") * F.col(f"x{i}")) for i in range(k + 1)),
                       *(F.sum(F.col("v") * F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs)).first()
        if sums[0] is None:
            return fit
        w = [fit.intercept, *fit.coefficients]
        g = [c * sums[i] + (w[i] if i else 0.0) for i in range(k + 1)]
        h = {q: c * s for q, s in zip(pairs, sums[k + 1 :])}
        a = [[h[min(i, j), max(i, j)] + (1.0 if i == j and i else 0.0) for j in range(k + 1)] for i in range(k + 1)]
        step = solve(a, g, [a[i][i] for i in range(k + 1)])
        w = [old - s for old, s in zip(w, step)]
        fit = Fit(tuple(inputs), w[1:], w[0], max(abs(s) for s in step))
    return fit


def linear_predictions(fit: Fit, test: DataFrame, id_col: str = "TransactionID", digits: int = 4) -> DataFrame:
    """ActualRiskScore and PredictedRiskScore of every test row; NULL predictions where an input is missing."""
    guess = F.when(usable(fit.inputs), F.round(score(fit), digits))
    return test.select(id_col, F.col("label").alias("ActualRiskScore"), guess.alias("PredictedRiskScore"))


def logistic_predictions(fit: Fit, test: DataFrame, id_col: str = "TransactionID", digits: int = 4) -> DataFrame:
    """Actual, Predicted (0/1 at probability above 0.5) and PredictedProb of every test row; NULL where an input is missing."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-score(fit)))
    ok = usable(fit.inputs)
    return test.select(id_col, F.col("label").cast("int").alias("Actual"), F.when(ok, (p > 0.5).cast("int")).alias("Predicted"),
                       F.when(ok, F.round(p, digits)).alias("PredictedProb"))


def fit_table(spark: SparkSession, fit: Fit, digits: int = 4) -> DataFrame:
    """(feature, coefficient): a row per input and the intercept."""
    rows = [*zip(fit.inputs, fit.coefficients), ("Intercept", fit.intercept)]
    return spark.createDataFrame([(n, round(float(v), digits)) for n, v in rows], "feature string, coefficient double")
