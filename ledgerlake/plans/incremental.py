"""Incremental feature and gold tables over a month-partitioned fact.

Both take the months that a fact upsert touched (``layers.upsert_fact_by_month``
returns them) and read and write what depends on those months only.

* Features: a day's row depends on the 30 days before it, so a change in a month
  reaches 30 days beyond its end.  The months it reaches are computed anew from the
  facts of those months and of the 30 days before them (the halo), and replaced.
* Gold: counts and sums per (month, dimension key, group) are kept as a partials
  table.  Partials of the touched months are replaced; the views add the months up,
  join today's dimensions and take shares of the sums.  Dimension attributes
  are joined when a view is read, so an overwritten account type needs no month again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.features import DEFAULT_HOME_COUNTRY, transaction_features
from ..sources.tables import among, read_partitions, replace_partitions
from . import gold

MONTH = "TransactionMonth"
#: Days that the longest rolling window looks back.
HALO_DAYS = 30

Months = set[str | None]


def _first_day(month: str) -> dt.date:
    return dt.date(int(month[:4]), int(month[5:7]), 1)


def _months_between(first: dt.date, last: dt.date) -> set[str]:
    out, year, month = set(), first.year, first.month
    while (year, month) <= (last.year, last.month):
        out.add(f"{year:04d}-{month:02d}")
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    return out


def _last_day(month: str) -> dt.date:
    return (_first_day(month) + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)


def reached(touched: Iterable[str | None]) -> Months:
    """Months whose features a change in ``touched`` can reach.  Facts without a date (NULL
    month) are peers of each other only."""
    out: Months = set()
    for m in touched:
        out |= {None} if m is None else _months_between(_first_day(m), _last_day(m) + dt.timedelta(days=HALO_DAYS))
    return out


def needed(months: Iterable[str | None]) -> Months:
    """Months whose facts the features of ``months`` are computed from."""
    out: Months = set()
    for m in months:
        out |= {None} if m is None else _months_between(_first_day(m) - dt.timedelta(days=HALO_DAYS), _last_day(m))
    return out


def feature_rows(fact: DataFrame, customer_dim: DataFrame, months: Months, home: str = DEFAULT_HOME_COUNTRY) -> DataFrame:
    """Features of ``months``; ``fact`` is read in their months and the halo before only."""
    near = fact.where(among(MONTH, needed(months)))
    rows = transaction_features(near.drop(MONTH), customer_dim, home=home)
    return rows.withColumn(MONTH, F.date_format("TransactionDate", "yyyy-MM")).where(among(MONTH, months))


def build_features(fact: DataFrame, customer_dim: DataFrame, path: str, home: str = DEFAULT_HOME_COUNTRY) -> DataFrame:
    """The whole feature table at ``path``, partitioned by month."""
    rows = transaction_features(fact.drop(MONTH), customer_dim, home=home)
    rows.withColumn(MONTH, F.date_format("TransactionDate", "yyyy-MM")).hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(path)
    return read_partitions(fact.sparkSession, path, MONTH)


def refresh_features(fact: DataFrame, customer_dim: DataFrame, touched: Months, path: str, home: str = DEFAULT_HOME_COUNTRY) -> DataFrame:
    """Bring the feature table at ``path`` up to the fact after a change in the ``touched`` months."""
    months = reached(touched)
    return replace_partitions(feature_rows(fact, customer_dim, months, home), path, MONTH, months)


# ---- gold ----------------------------------------------------------------------

def _measures() -> dict[str, tuple[Column, Column, Column, Column]]:
    """measure -> (dimension key, group on the fact's side, counted value, summed value)."""
    none, text = F.lit(None).cast("int"), lambda c: F.col(c).cast("string")
    return {"account_laundering": (F.col("AccountSK"), F.lit(None).cast("string"), F.col("IsLaundered").cast("int"), none),
            "customer_fraud": (F.col("CustomerSK"), text("IsFraud"), F.col("IsFraud").cast("int"), none),
            "customer_laundering": (F.col("CustomerSK"), text("Channel"), F.col("IsLaundered").cast("int"), none),
            "customer_weekday": (F.col("CustomerSK"), F.date_format("TransactionDate", "E"), F.col("RiskScore"), F.col("RiskScore")),
            # the trend counts the flagged rows of known customers, as the feature view has them
            "day_fraud": (F.lit(None).cast("long"), text("TransactionDate"), F.when(F.col("IsFraud") & F.col("CustomerSK").isNotNull(), 1), none)}


def partial_rows(fact: DataFrame) -> DataFrame:
    """(month, Measure, Key, Group, N, S): additive counts and sums, one scan, aggregated before the shuffle."""
    each = F.array(*(F.struct(F.lit(name).alias("Measure"), key.cast("long").alias("Key"), group.alias("Group"),
                              value.isNotNull().cast("long").alias("n"), total.cast("long").alias("s"))
                     for name, (key, group, value, total) in _measures().items()))
    rows = fact.select(MONTH, "CustomerSK", F.explode(each).alias("m")).where((F.col("m.Measure") != "day_fraud") | F.col("CustomerSK").isNotNull())
    return (rows.groupBy(MONTH, "m.Measure", "m.Key", "m.Group").agg(F.sum("m.n").alias("N"), F.sum("m.s").alias("S")))


def build_partials(fact: DataFrame, path: str) -> DataFrame:
    """The whole partials table at ``path``, partitioned by month."""
    partial_rows(fact).hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(path)
    return read_partitions(fact.sparkSession, path, MONTH)


def refresh_partials(fact: DataFrame, touched: Months, path: str) -> DataFrame:
    """Replace the partials of the touched months; other months of the fact aren't read."""
    return replace_partitions(partial_rows(fact.where(among(MONTH, touched))), path, MONTH, touched)


def _summed(partials: DataFrame, measure: str, key: str, group: str | None = None) -> DataFrame:
    """One measure over all months, in the columns that the gold views aggregate."""
    names = [F.col("Key").alias(key), *([F.col("Group").alias(group)] if group else [])]
    return partials.where(F.col("Measure") == measure).groupBy(*names).agg(F.sum("N").alias("_w"), F.sum("S").alias("_s"))


def gold_from_partials(partials: DataFrame, customer_dim: DataFrame, account_dim: DataFrame,
                       excluded: str = gold.DEFAULT_EXCLUDED_COUNTRY) -> dict[str, DataFrame]:
    """The seven gold views by their names, from partials and today's dimensions."""
    by_account = _summed(partials, "account_laundering", "AccountSK")
    fraud = _summed(partials, "customer_fraud", "CustomerSK", "IsFraud").withColumn("IsFraud", F.col("IsFraud").cast("boolean"))
    channel = _summed(partials, "customer_laundering", "CustomerSK", "Channel")
    weekday = _summed(partials, "customer_weekday", "CustomerSK", "DayOfWeek").withColumnRenamed("_w", "_c")
    return {"account_type_launderingrate": gold.account_type_rate_of(by_account, account_dim),
            "Uganda_Fraud": gold.country_fraud_share_of(fraud, customer_dim, excluded),
            "luandering_channel": gold.channel_rate_of(channel, customer_dim),
            "Country_FraudVol": gold.country_fraud_volume_of(fraud, customer_dim),
            "riskscore_dow": gold.riskscore_by_weekday_of(weekday, customer_dim),
            "luandering_account": gold.account_kyc_rate_of(by_account, account_dim, customer_dim),
            "Country_LaunderingRate": gold.country_rate_of(channel, customer_dim)}


def daily_volume_from_partials(partials: DataFrame) -> DataFrame:
    """(Date, FraudVolume) of ``models.daily_flag_volume`` over the feature view."""
    days = partials.where(F.col("Measure") == "day_fraud").groupBy("Group").agg(F.sum("N").alias("FraudVolume"))
    return days.select(F.col("Group").cast("date").alias("Date"), "FraudVolume")
