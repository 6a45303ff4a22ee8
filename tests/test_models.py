"""Model jobs: optimality of the fits, metrics against direct formulas."""

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.operators import models
from ledgerlake.plans.model_jobs import forecast_job, fraud_job, risk_job


def _inputs(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5)) * [1, 50, 0.5, 1, 20]
    z = 0.8 * x[:, 0] - 0.02 * x[:, 1] + 0.3
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-z))).astype(float)
    r = 3 * x[:, 0] + 0.1 * x[:, 1] + rng.normal(size=n)
    rows = [(str(i), float(y[i]), float(r[i]), *map(float, x[i])) for i in range(n)]
    cols = "id string, label double, score double, " + ", ".join(f"x{j} double" for j in range(5))
    return spark.createDataFrame(rows, cols), x, y, r


def test_logistic_matches_c1_objective(spark):
    df, x, y, _ = _inputs(spark)
    inputs = [f"x{j}" for j in range(5)]
    model = models.fit_classifier(df.select("id", "label", *inputs), inputs)
    lr = model.stages[-1]
    w, b = lr.coefficients.toArray(), lr.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    grad_w = w + x.T @ (p - y)          # gradient of 0.5|w|^2 + C*sum(logloss), C=1
    grad_b = np.sum(p - y)
    assert np.max(np.abs(grad_w)) < 1e-3 and abs(grad_b) < 1e-3


def test_ols_residual_orthogonal(spark):
    df, x, _, r = _inputs(spark)
    inputs = [f"x{j}" for j in range(5)]
    model = models.fit_regressor(df.select("id", F.col("score").alias("label"), *inputs), inputs)
    lr = model.stages[-1]
    res = r - (x @ lr.coefficients.toArray() + lr.intercept)
    assert abs(res.sum()) < 1e-6 * len(r)
    assert np.max(np.abs(x.T @ res)) < 1e-5 * len(r) * 50


def test_report_and_r2(spark):
    pred = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "Actual int, Predicted int")
    rep = {r.label: r for r in models.classification_report(pred).collect()}
    assert rep["1"].precision == 0.5 and rep["1"].recall == 0.5 and rep["1"].support == 2
    assert rep["0"].precision == round(2 / 3, 6) and rep["0"].recall == round(2 / 3, 6)
    assert rep["accuracy"].precision == 0.6 and rep["macro avg"].support == 5
    cm = {r.Actual: (r.Predicted0, r.Predicted1) for r in models.confusion_matrix(pred).collect()}
    assert cm == {0: (2, 1), 1: (1, 1)}
    assert models.accuracy(pred).first().accuracy == 0.6
    yp = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5)], "y double, p double")
    assert abs(models.r2_score(yp, "y", "p").first().r2 - 0.75) < 1e-12


def test_jobs_on_feature_shaped_input(spark):
    from datetime import date, timedelta
    rows = []
    for i in range(240):
        rows.append((f"t{i}", date(2025, 1, 1) + timedelta(days=i % 30), i % 3 == 0, i % 100,
                     1 + i % 4, float(100 + i), 1.0 + (i % 7) / 10, i % 2, i % 90))
    f = spark.createDataFrame(rows, "TransactionID string, TransactionDate date, IsFraud boolean, RiskScore int, "
                                    "TxnCount_Last_7_Days long, AvgAmount_Last_30_Days double, Amount_vs_Avg double, "
                                    "IsForeignTransaction int, CustomerTenure int")
    fr = fraud_job(f)
    assert fr.predictions.count() > 0 and fr.metrics.count() == 1 and fr.coefficients.count() == 6
    rr = risk_job(f)
    assert rr.predictions.count() > 0
    fc = forecast_job(f)
    assert fc.predictions.count() == 30
    assert {r.metric for r in fc.metrics.collect()} == {"r2", "slope", "intercept"}


def test_rows_that_cannot_be_scored_keep_a_prediction_row(spark):
    df, *_ = _inputs(spark)
    inputs = [f"x{j}" for j in range(5)]
    rows = df.select("id", "label", *inputs)
    odd = spark.createDataFrame([("a", 1.0, None, 1.0, 1.0, 1.0, 1.0), ("b", 0.0, 1.0, float("nan"), 1.0, 1.0, 1.0)], rows.schema)
    test = rows.limit(10).unionByName(odd)
    pred = models.classifier_predictions(models.fit_classifier(rows, inputs), test, "id")
    assert pred.count() == 12 and pred.where("Predicted IS NULL AND PredictedProb IS NULL").count() == 2
    assert models.accuracy(pred).first().n == 10
    pred = models.regressor_predictions(models.fit_regressor(rows, inputs), test, "id")
    assert pred.count() == 12 and {r.id for r in pred.where("PredictedRiskScore IS NULL").collect()} == {"a", "b"}


def test_r2_of_large_values(spark):
    yp = spark.createDataFrame([(1e9 + i, 1e9 + 4.5) for i in range(10)], "y double, p double")
    assert abs(models.r2_score(yp, "y", "p").first().r2) < 1e-6
