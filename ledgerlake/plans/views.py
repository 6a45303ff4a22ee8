"""Named views over a run, for users who query the layers with SQL.

Temp views are always replaced (a changed definition is never silently
ignored).  Stored views are SQL over the catalog's tables and carry the order in
which the reference shows them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import overwrite_table
from .bronze import ingest_bronze
from .gold import DEFAULT_EXCLUDED_COUNTRY
from .layers import SilverLayer, run_features, run_gold, run_silver_partitioned
from .model_jobs import ModelRun, forecast_job, fraud_job, publish_run, risk_job


def register_views(layer: SilverLayer, prefix: str = "", home: str | None = None) -> dict[str, DataFrame]:
    """``customer_dim``, ``account_dim``, ``transaction_fact``, the seven gold
    views by their reference names and ``Transaction_Features``."""
    views: dict[str, DataFrame] = {"customer_dim": layer.customer_dim, "account_dim": layer.account_dim,
                                   "transaction_fact": layer.fact}
    views.update(run_gold(layer))
    views["Transaction_Features"] = run_features(layer, **({"home": home} if home else {}))
    for name, df in views.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    return views


# The names under which the model jobs' tables are read.
PREDICTION_TABLES = {"fraud": "fraud_predictions", "risk": "risk_score_predictions", "forecast": "fraud_forecast"}
METRICS_TABLE = "model_metrics"


#: The gold views as SQL over the catalog's silver tables ({db}, {excluded} and {home} are filled in); the
#: order is that of ``sorted_view``.  The dimensions grow with the input: they are merged, never broadcast.
VIEW_SQL = {
    "account_type_launderingrate": """
SELECT AccountType, round(try_divide(n * 100, sum(n) OVER ()), 2) AS LaunderingRate FROM (
  SELECT /*+ MERGE(a) */ a.AccountType, count(f.IsLaundered) AS n FROM {db}.transaction_fact f JOIN {db}.account_dim a ON f.AccountSK = a.AccountSK GROUP BY 1)
ORDER BY LaunderingRate DESC NULLS LAST, AccountType""",
    "Uganda_Fraud": """
SELECT Country, IsFraud, CAST(round(try_divide(CAST(n AS DECIMAL(20,0)) * 100.0, CAST(sum(n) OVER () AS DECIMAL(20,0))), 2) AS DOUBLE) AS RiskCategoryRate FROM (
  SELECT /*+ MERGE(c) */ c.Country, f.IsFraud, count(f.IsFraud) AS n FROM {db}.transaction_fact f JOIN {db}.customer_dim c ON f.CustomerSK = c.CustomerSK
  WHERE c.Country <> '{excluded}' GROUP BY 1, 2)
ORDER BY RiskCategoryRate DESC NULLS LAST, Country, IsFraud""",
    "luandering_channel": """
SELECT Channel, KYCStatus, round(try_divide(n * 100, sum(n) OVER ()), 2) AS LaunderingRate FROM (
  SELECT /*+ MERGE(c) */ f.Channel, c.KYCStatus, count(f.IsLaundered) AS n FROM {db}.transaction_fact f JOIN {db}.customer_dim c ON f.CustomerSK = c.CustomerSK GROUP BY 1, 2)
ORDER BY LaunderingRate DESC NULLS LAST, Channel, KYCStatus""",
    "Country_FraudVol": """
SELECT /*+ MERGE(c) */ c.Country, f.IsFraud, count(f.IsFraud) AS FraudCount FROM {db}.transaction_fact f JOIN {db}.customer_dim c ON f.CustomerSK = c.CustomerSK
GROUP BY 1, 2 ORDER BY FraudCount DESC NULLS LAST, Country, IsFraud""",
    "riskscore_dow": """
SELECT /*+ MERGE(c) */ c.CustomerName AS Name, date_format(f.TransactionDate, 'E') AS DayOfWeek, round(avg(f.RiskScore), 0) AS AvgRiskScore
FROM {db}.transaction_fact f JOIN {db}.customer_dim c ON f.CustomerSK = c.CustomerSK
GROUP BY 1, 2 ORDER BY AvgRiskScore DESC NULLS LAST, Name, DayOfWeek""",
    "luandering_account": """
SELECT AccountType, KYCStatus, round(try_divide(n * 100, sum(n) OVER ()), 2) AS LaunderingRate FROM (
  SELECT /*+ MERGE(a, c) */ a.AccountType, c.KYCStatus, count(f.IsLaundered) AS n FROM {db}.transaction_fact f JOIN {db}.account_dim a ON f.AccountSK = a.AccountSK
  JOIN {db}.customer_dim c ON a.CustomerSK = c.CustomerSK GROUP BY 1, 2)
ORDER BY LaunderingRate DESC NULLS LAST, AccountType, KYCStatus""",
    "Country_LaunderingRate": """
SELECT Country, round(try_divide(n * 100, sum(n) OVER ()), 2) AS LaunderingRate FROM (
  SELECT /*+ MERGE(c) */ c.Country, count(f.IsLaundered) AS n FROM {db}.transaction_fact f JOIN {db}.customer_dim c ON f.CustomerSK = c.CustomerSK GROUP BY 1)
ORDER BY LaunderingRate DESC NULLS LAST, Country""",
}


def create_gold_views(spark: SparkSession, database: str, excluded: str = DEFAULT_EXCLUDED_COUNTRY) -> list[str]:
    """``CREATE OR REPLACE VIEW`` of the seven gold views over the database's silver tables.

    The views are stored in the catalog, so other sessions and later jobs read them by
    name, and they follow their tables.  The window over all groups runs on one row
    per group of a few attributes; a reader's own ORDER BY replaces the view's.
    """
    db, names = f"`{database}`", []
    for name, body in VIEW_SQL.items():
        if spark.catalog.tableExists(f"{database}.{name}") and spark.catalog.getTable(f"{database}.{name}").tableType != "VIEW":
            spark.sql(f"DROP TABLE {db}.`{name}`")  # an earlier release stored a table of that name
        text = body.replace("{db}", db).replace("{excluded}", excluded.replace("'", "''"))
        spark.sql(f"CREATE OR REPLACE VIEW {db}.`{name}` AS {text}")
        names.append(f"{database}.{name}")
    return names


def publish_layer(layer: SilverLayer, database: str, home: str | None = None) -> list[str]:
    """Store the silver tables and ``Transaction_Features`` as tables of ``database`` and the
    seven gold views as views over them, so that the next scheduled job reads them by name.

    Readers of a gold view see the silver tables as they are; none is a copy that
    a later step of the run has yet to replace.
    """
    spark = layer.fact.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    tables: dict[str, DataFrame] = {"customer_dim": layer.customer_dim, "account_dim": layer.account_dim,
                                    "transaction_fact": layer.fact}
    if layer.rejects is not None:
        tables["rejects"] = layer.rejects
    tables["Transaction_Features"] = run_features(layer, **({"home": home} if home else {}))
    names = []
    for name, df in tables.items():
        overwrite_table(df, f"{database}.{name}")
        names.append(f"{database}.{name}")
    return names + create_gold_views(spark, database)


def sorted_view(df: DataFrame) -> DataFrame:
    """A gold view in the order its readers want: the largest measure first (NULL
    last), equal ones by the group columns."""
    measure = df.columns[-1]
    return df.orderBy(F.col(measure).desc_nulls_last(), *df.columns[:-1])


def run_all(spark: SparkSession, landing: dict[str, str], root: str, database: str, run_id: str,
            home: str | None = None) -> dict[str, ModelRun]:
    """One scheduled run from the landing folders to the models: bronze loads,
    partitioned silver tables, gold views and features by name, three model jobs
    whose predictions are replaced and whose metrics are appended."""
    bronze = ingest_bronze(spark, landing, f"{root}/bronze")
    layer = run_silver_partitioned(bronze.customer_raw, bronze.account_raw, bronze.transaction_raw, f"{root}/silver", run_id,
                                   bronze.quarantine)
    publish_layer(layer, database, home)
    features = spark.table(f"{database}.Transaction_Features")
    runs = {"fraud": fraud_job(features), "risk": risk_job(features), "forecast": forecast_job(features)}
    for key, run in runs.items():
        publish_run(run, f"{database}.{PREDICTION_TABLES[key]}", f"{database}.{METRICS_TABLE}", f"{root}/models/{key}")
    return runs
