"""Model jobs on MLlib: fraud classifier, risk-score regressor, daily fraud trend,
and the evaluation metrics, all computed on executors (no driver-side frame).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import FEATURE_COLUMNS
from ..session import materialize as write_once
from .keys import hash_split


def model_input(features: DataFrame, label: str, id_col: str = "TransactionID",
                inputs: Sequence[str] = FEATURE_COLUMNS, materialize: bool = True) -> DataFrame:
    """id, label (double) and the numeric inputs (double); rows without a label
    are left out (a fit cannot use them).

    ``materialize`` writes the rows once to the shared work folder, so
    the split, the fit and the predictions all read them instead of re-running
    the feature plan three times.
    """
    out = features.select(id_col, F.col(label).cast("double").alias("label"),
                          *[F.col(c).cast("double").alias(c) for c in inputs]).where(F.col("label").isNotNull())
    return write_once(out, "model-input") if materialize else out


def _assembler(inputs: Sequence[str]) -> VectorAssembler:
    # a fit cannot use rows with a NULL input; predictions keep them (``_scored``)
    return VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid="skip")


def training_set(train: DataFrame, inputs: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Assembled training rows, kept in memory for the iterative fit.

    The optimizer makes one pass per iteration over these rows; they come from
    a materialized :func:`model_input`, so a lost cached block is rebuilt from
    the checkpoint files, not from the feature plan.
    """
    assembled = _assembler(inputs).transform(train).select("label", "features")
    return assembled.persist(StorageLevel.MEMORY_AND_DISK)


def fit_classifier(train: DataFrame, inputs: Sequence[str] = FEATURE_COLUMNS, max_iter: int = 1000,
                   c: float = 1.0) -> PipelineModel:
    """L2 logistic regression with intercept equal to the optimum of
    ``0.5 |w|^2 + C * sum(logloss)``: Spark's objective is
    ``mean(logloss) + regParam/2 |w|^2``, so ``regParam = 1 / (C * n)`` on
    unstandardized inputs."""
    data = training_set(train, inputs)
    try:
        n = max(1, data.count())
        lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter,
                                regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False,
                                tol=1e-9, family="binomial")
        return PipelineModel(stages=[_assembler(inputs), lr.fit(data)])
    finally:
        data.unpersist()


def scorable(inputs: Sequence[str] = FEATURE_COLUMNS) -> Column:
    """True for rows whose inputs are all numbers (no NULL, no NaN)."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in inputs])


def _scored(model: PipelineModel, test: DataFrame, scores: dict[str, Column], labels: list[Column]) -> DataFrame:
    """Scores of all rows of ``test``; rows with a missing input keep NULL scores."""
    inputs = model.stages[0].getInputCols()
    good, bad = test.where(scorable(inputs)), test.where(~scorable(inputs))
    out = model.transform(good).select(*labels, *[c.alias(n) for n, c in scores.items()])
    types = {f.name: f.dataType for f in out.schema.fields}
    return out.unionByName(bad.select(*labels, *[F.lit(None).cast(types[n]).alias(n) for n in scores]))


def classifier_predictions(model: PipelineModel, test: DataFrame, id_col: str = "TransactionID") -> DataFrame:
    """Actual, Predicted (0/1) and PredictedProb (probability of class 1), one row
    per test row; NULL predictions where an input is missing."""
    return _scored(model, test, {"Predicted": F.col("prediction").cast("int"),
                                 "PredictedProb": vector_to_array("probability")[1]},
                   [F.col(id_col), F.col("label").cast("int").alias("Actual")])


def fit_regressor(train: DataFrame, inputs: Sequence[str] = FEATURE_COLUMNS) -> PipelineModel:
    """Ordinary least squares with intercept (normal equations, no penalty)."""
    lr = LinearRegression(featuresCol="features", labelCol="label", solver="normal", regParam=0.0,
                          elasticNetParam=0.0, standardization=False)
    data = training_set(train, inputs)
    try:
        return PipelineModel(stages=[_assembler(inputs), lr.fit(data)])
    finally:
        data.unpersist()


def regressor_predictions(model: PipelineModel, test: DataFrame, id_col: str = "TransactionID") -> DataFrame:
    """ActualRiskScore and PredictedRiskScore, one row per test row; NULL
    predictions where an input is missing."""
    return _scored(model, test, {"PredictedRiskScore": F.col("prediction")},
                   [F.col(id_col), F.col("label").alias("ActualRiskScore")])


def coefficients(model: PipelineModel, inputs: Sequence[str] = FEATURE_COLUMNS, digits: int = 2) -> DataFrame:
    """Feature name and coefficient (one row per input plus the intercept)."""
    m = model.stages[-1]
    spark = SparkSession.getActiveSession()
    rows = [(name, round(float(v), digits)) for name, v in zip(inputs, m.coefficients.toArray())]
    rows.append(("Intercept", round(float(m.intercept), digits)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


# ---- metrics -----------------------------------------------------------------
def accuracy(pred: DataFrame, actual: str = "Actual", predicted: str = "Predicted") -> DataFrame:
    """Share of equal rows among those with a prediction, and their number."""
    same = (F.col(actual) == F.col(predicted)).cast("double")
    return pred.agg(F.avg(same).alias("accuracy"), F.count(same).alias("n"))


def confusion_matrix(pred: DataFrame, actual: str = "Actual", predicted: str = "Predicted") -> DataFrame:
    """One row per actual class with the counts predicted as 0 and as 1."""
    return pred.groupBy(F.col(actual).alias("Actual")).agg(
        F.count_if(F.col(predicted) == 0).alias("Predicted0"),
        F.count_if(F.col(predicted) == 1).alias("Predicted1"))


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_report(pred: DataFrame, actual: str = "Actual", predicted: str = "Predicted",
                          digits: int = 6) -> DataFrame:
    """Precision, recall, F1 and support per class (0, 1), accuracy, macro and
    weighted averages; undefined ratios are 0.  One pass of conditional counts,
    then a five-row ``stack``."""
    a, p = F.col(actual), F.col(predicted)
    c = pred.agg(F.count_if((a == 1) & (p == 1)).alias("tp"), F.count_if((a == 0) & (p == 1)).alias("fp"),
                 F.count_if((a == 1) & (p == 0)).alias("fn"), F.count_if((a == 0) & (p == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    s1, s0 = tp + fn, tn + fp
    p1, r1 = _div(tp, tp + fp), _div(tp, s1)
    p0, r0 = _div(tn, tn + fn), _div(tn, s0)
    m = c.select(
        p1.alias("p1"), r1.alias("r1"), _div(2 * p1 * r1, p1 + r1).alias("f1"), s1.alias("s1"),
        p0.alias("p0"), r0.alias("r0"), _div(2 * p0 * r0, p0 + r0).alias("f0"), s0.alias("s0"),
        _div(tp + tn, s1 + s0).alias("acc"))
    n = F.col("s0") + F.col("s1")
    wavg = lambda x0, x1: _div(F.col(x0) * F.col("s0") + F.col(x1) * F.col("s1"), n)
    def row(label, prec, rec, f1, sup):
        return F.struct(F.lit(label).alias("label"), prec.alias("precision"), rec.alias("recall"),
                        f1.alias("f1"), sup.cast("long").alias("support"))

    c_ = F.col
    rows = m.select(F.explode(F.array(
        row("0", c_("p0"), c_("r0"), c_("f0"), c_("s0")),
        row("1", c_("p1"), c_("r1"), c_("f1"), c_("s1")),
        row("accuracy", c_("acc"), c_("acc"), c_("acc"), n),
        row("macro avg", (c_("p0") + c_("p1")) / 2, (c_("r0") + c_("r1")) / 2, (c_("f0") + c_("f1")) / 2, n),
        row("weighted avg", wavg("p0", "p1"), wavg("r0", "r1"), wavg("f0", "f1"), n),
    )).alias("r")).select("r.*")
    return rows.select("label", *[F.round(F.col(x), digits).alias(x) for x in ("precision", "recall", "f1")],
                       F.col("support").cast("long").alias("support"))


def gradients(model: PipelineModel, rows: DataFrame, digits: int = 4, c: float = 1.0) -> DataFrame:
    """(input, gradient) of the fitted objective at its optimum, per input and for the intercept.

    For the linear model the mean of residual times input, for the logistic model
    that plus the penalty's ``w / (c n)``, each divided by the input's root mean
    square: 0 for a right fit.
    """
    inputs = model.stages[0].getInputCols()
    fitted = model.stages[-1]
    logistic = hasattr(fitted, "interceptVector")
    used = rows.where(scorable(inputs) & F.col("label").isNotNull())
    out = model.transform(used)
    guess = vector_to_array("probability")[1] if logistic else F.col("prediction")
    n = F.count(F.lit(1))
    parts = []
    for name, w in [*zip(inputs, fitted.coefficients.toArray()), ("Intercept", 0.0)]:
        x = F.lit(1.0) if name == "Intercept" else F.col(name)
        penalty = F.lit(float(w) / c) / n if logistic else F.lit(0.0)
        size = F.greatest(F.sqrt(F.avg(x * x)), F.lit(1e-12))
        parts.append(F.struct(F.lit(name).alias("input"),
                              (F.round((F.avg(x * (guess - F.col("label"))) + penalty) / size, digits) + 0.0).alias("gradient")))
    return out.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def r2_score(df: DataFrame, y: str, p: str) -> DataFrame:
    """``1 - SSE/SST`` in one aggregate pass over the rows with both values.

    ``SST`` is ``n * var_pop(y)``: the variance is updated around the running
    mean, so large values of ``y`` do not cancel as ``sum(y^2) - sum(y)^2 / n`` would.
    """
    yc, pc = F.col(y).cast("double"), F.col(p).cast("double")
    ok = yc.isNotNull() & pc.isNotNull()
    yv, pv = F.when(ok, yc), F.when(ok, pc)
    n = F.count(yv)
    sse = F.sum((yv - pv) ** 2)
    sst = F.var_pop(yv) * n
    return df.agg((1 - F.try_divide(sse, sst)).alias("r2"), n.alias("n"))


# ---- daily trend -----------------------------------------------------------
def daily_flag_volume(features: DataFrame, date_col: str = "TransactionDate", flag: str = "IsFraud") -> DataFrame:
    """Rows with a true flag per calendar day (days without one give 0)."""
    return (features.groupBy(F.to_date(date_col).alias("Date"))
            .agg(F.count(F.when(F.col(flag) == F.lit(True), 1)).alias("FraudVolume")))


def with_day_index(daily: DataFrame) -> DataFrame:
    """Position among days that have rows (NULL date last), from 0.

    One row per day, so the unpartitioned window holds a few thousand rows at
    any data size.
    """
    w = Window.orderBy(F.col("Date").asc_nulls_last())
    return daily.withColumn("DayIndex", (F.row_number().over(w) - 1).cast("long"))


def trend_fit(indexed: DataFrame, digits: int = 6) -> DataFrame:
    """OLS of volume on day index: slope, intercept, in-sample R²."""
    y, x = F.col("FraudVolume").cast("double"), F.col("DayIndex").cast("double")
    return indexed.agg(F.round(F.regr_slope(y, x), digits).alias("slope"),
                       F.round(F.regr_intercept(y, x), digits).alias("intercept"),
                       F.round(F.regr_r2(y, x), digits).alias("r2"),
                       F.count(F.lit(1)).alias("days"))


def trend_predictions(indexed: DataFrame, digits: int = 6) -> DataFrame:
    """Date, FraudVolume, DayIndex, Predicted (in-sample)."""
    y, x = F.col("FraudVolume").cast("double"), F.col("DayIndex").cast("double")
    slope = indexed.agg(F.regr_slope(y, x)).scalar()
    icpt = indexed.agg(F.regr_intercept(y, x)).scalar()
    return indexed.select("Date", "FraudVolume", "DayIndex",
                          F.round(icpt + slope * x, digits).alias("Predicted"))


def split_for_models(inputs: DataFrame, id_col: str = "TransactionID", seed: int = 42):
    return hash_split(inputs, id_col, seed=seed, test_fraction=0.2)
