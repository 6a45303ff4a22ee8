"""Model jobs over the feature view: fit, predict, evaluate, publish.

Each job keeps the data on the executors (MLlib fit and transform); only the
fitted coefficients (one number per input) come back to the driver.  Output
tables are overwritten per run; metrics are appended as (run time, job,
metric, value) rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import models
from ..session import materialize as write_once
from ..sources.tables import append_table, overwrite_table


@dataclass
class ModelRun:
    predictions: DataFrame
    metrics: DataFrame
    coefficients: DataFrame | None = None
    confusion: DataFrame | None = None
    report: DataFrame | None = None
    model: PipelineModel | None = None


def _metrics(job: str, pairs: list[tuple[str, DataFrame, str]]) -> DataFrame:
    parts = [df.select(F.lit(job).alias("job"), F.lit(metric).alias("metric"),
                       F.col(col).cast("double").alias("value")) for metric, df, col in pairs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("run_ts", F.current_timestamp())


def fraud_job(features: DataFrame, seed: int = 42) -> ModelRun:
    """Logistic regression on IsFraud: predictions, accuracy, confusion, report."""
    inp = models.model_input(features, "IsFraud")
    train, test = models.split_for_models(inp, seed=seed)
    model = models.fit_classifier(train)
    pred = write_once(models.classifier_predictions(model, test), "fraud-predictions")
    acc = models.accuracy(pred)
    return ModelRun(pred, _metrics("fraud_classifier", [("accuracy", acc, "accuracy")]), models.coefficients(model),
                    models.confusion_matrix(pred), models.classification_report(pred), model)


def risk_job(features: DataFrame, seed: int = 42) -> ModelRun:
    """Linear regression on RiskScore: predictions, held-out R², coefficients."""
    inp = models.model_input(features, "RiskScore")
    train, test = models.split_for_models(inp, seed=seed)
    model = models.fit_regressor(train)
    pred = write_once(models.regressor_predictions(model, test), "risk-predictions")
    r2 = models.r2_score(pred, "ActualRiskScore", "PredictedRiskScore")
    return ModelRun(pred, _metrics("risk_regressor", [("r2", r2, "r2")]), models.coefficients(model), model=model)


def forecast_job(features: DataFrame) -> ModelRun:
    """Daily fraud volume, day index, in-sample trend prediction and R²."""
    indexed = models.with_day_index(models.daily_flag_volume(features))
    pred = models.trend_predictions(indexed)
    fit = models.trend_fit(indexed)
    return ModelRun(pred, _metrics("fraud_forecast", [("r2", fit, "r2"), ("slope", fit, "slope"),
                                                      ("intercept", fit, "intercept")]))


def publish_run(run: ModelRun, predictions_table: str, metrics_table: str, model_path: str | None = None) -> None:
    """Overwrite the prediction table, append the run's metrics and, with
    ``model_path``, save the fitted pipeline there (MLlib's own format)."""
    overwrite_table(run.predictions, predictions_table)
    append_table(run.metrics, metrics_table)
    if model_path and run.model is not None:
        run.model.write().overwrite().save(model_path)
