"""Gold views: shares, counts and means of the fact by dimension attributes.

Plan shape for every view: the fact is first reduced to one row per
(dimension key, fact-side group columns) with a partial + final aggregate,
then joined to the (pruned) dimension and re-grouped by the dimension
attributes.  Counts are additive, so this equals grouping the joined rows,
but the join sees one row per key instead of one per transaction and a hot
key is collapsed map-side before any shuffle.  Both sides of that join grow with
the input and are merged: none is broadcast on the strength of its compressed size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import share_of_counts

# Fixed value: the country excluded from the fraud-share view.
DEFAULT_EXCLUDED_COUNTRY = "Kenya"


def _share(grouped: DataFrame, keys, out: str, decimal: bool = False) -> DataFrame:
    """grouped has ``keys`` + ``_n`` (additive counts); share of the grand total."""
    return share_of_counts(grouped, keys, out, "_n", decimal=decimal)


def _pre(fact: DataFrame, key: str, value: str, *fact_keys) -> DataFrame:
    return fact.groupBy(key, *fact_keys).agg(F.count(value).alias("_w"))


# Each view comes in two steps: the fact reduced to (dimension key, group) counts, and ``..._of``
# those counts.  The second step also takes counts that were added up from stored partials
# (``plans.incremental``).


def account_type_laundering_rate(fact: DataFrame, account_dim: DataFrame) -> DataFrame:
    """Share of laundering-flagged (non-NULL) rows by account type."""
    return account_type_rate_of(_pre(fact, "AccountSK", "IsLaundered"), account_dim)


def account_type_rate_of(pre: DataFrame, account_dim: DataFrame) -> DataFrame:
    j = pre.join(account_dim.select("AccountSK", "AccountType").hint("merge"), "AccountSK")
    g = j.groupBy("AccountType").agg(F.sum("_w").alias("_n"))
    return _share(g, ["AccountType"], "LaunderingRate")


def country_fraud_share(fact: DataFrame, customer_dim: DataFrame,
                        excluded: str = DEFAULT_EXCLUDED_COUNTRY) -> DataFrame:
    """Share by Country x IsFraud with one country left out (decimal ``*100.0`` form)."""
    return country_fraud_share_of(_pre(fact, "CustomerSK", "IsFraud", "IsFraud"), customer_dim, excluded)


def country_fraud_share_of(pre: DataFrame, customer_dim: DataFrame,
                           excluded: str = DEFAULT_EXCLUDED_COUNTRY) -> DataFrame:
    dim = customer_dim.where(F.col("Country") != F.lit(excluded)).select("CustomerSK", "Country")
    g = pre.join(dim.hint("merge"), "CustomerSK").groupBy("Country", "IsFraud").agg(F.sum("_w").alias("_n"))
    return _share(g, ["Country", "IsFraud"], "RiskCategoryRate", decimal=True)


def laundering_by_channel(fact: DataFrame, customer_dim: DataFrame) -> DataFrame:
    """Share by Channel x KYCStatus."""
    return channel_rate_of(_pre(fact, "CustomerSK", "IsLaundered", "Channel"), customer_dim)


def channel_rate_of(pre: DataFrame, customer_dim: DataFrame) -> DataFrame:
    g = (pre.join(customer_dim.select("CustomerSK", "KYCStatus").hint("merge"), "CustomerSK")
         .groupBy("Channel", "KYCStatus").agg(F.sum("_w").alias("_n")))
    return _share(g, ["Channel", "KYCStatus"], "LaunderingRate")


def country_fraud_volume(fact: DataFrame, customer_dim: DataFrame) -> DataFrame:
    """COUNT(IsFraud) by Country x IsFraud."""
    return country_fraud_volume_of(_pre(fact, "CustomerSK", "IsFraud", "IsFraud"), customer_dim)


def country_fraud_volume_of(pre: DataFrame, customer_dim: DataFrame) -> DataFrame:
    return (pre.join(customer_dim.select("CustomerSK", "Country").hint("merge"), "CustomerSK")
            .groupBy("Country", "IsFraud").agg(F.sum("_w").alias("FraudCount")))


def riskscore_by_weekday(fact: DataFrame, customer_dim: DataFrame) -> DataFrame:
    """ROUND(AVG(RiskScore)) by customer name x weekday name (``Mon`` ...).

    Grouped by the *name*, so versions and customers sharing a name merge.
    The mean is rebuilt from additive sum and count (exact for integers).
    """
    dow = F.date_format("TransactionDate", "E")
    pre = (fact.groupBy("CustomerSK", dow.alias("DayOfWeek"))
           .agg(F.sum("RiskScore").alias("_s"), F.count("RiskScore").alias("_c")))
    return riskscore_by_weekday_of(pre, customer_dim)


def riskscore_by_weekday_of(pre: DataFrame, customer_dim: DataFrame) -> DataFrame:
    j = pre.join(customer_dim.select("CustomerSK", F.col("CustomerName").alias("Name")).hint("merge"), "CustomerSK")
    g = j.groupBy("Name", "DayOfWeek").agg(F.sum("_s").alias("_s"), F.sum("_c").alias("_c"))
    mean = F.when(F.col("_c") > 0, F.col("_s").cast("double") / F.col("_c").cast("double"))
    return g.select("Name", "DayOfWeek", F.round(mean, 0).alias("AvgRiskScore"))


def laundering_by_account_kyc(fact: DataFrame, account_dim: DataFrame,
                              customer_dim: DataFrame) -> DataFrame:
    """Share by AccountType x KYCStatus through fact -> account -> customer."""
    return account_kyc_rate_of(_pre(fact, "AccountSK", "IsLaundered"), account_dim, customer_dim)


def account_kyc_rate_of(pre: DataFrame, account_dim: DataFrame, customer_dim: DataFrame) -> DataFrame:
    acc = account_dim.select("AccountSK", F.col("CustomerSK").alias("_acsk"), "AccountType")
    cus = customer_dim.select(F.col("CustomerSK").alias("_acsk"), "KYCStatus")
    g = (pre.join(acc.hint("merge"), "AccountSK").join(cus.hint("merge"), "_acsk")
         .groupBy("AccountType", "KYCStatus").agg(F.sum("_w").alias("_n")))
    return _share(g, ["AccountType", "KYCStatus"], "LaunderingRate")


def country_laundering_rate(fact: DataFrame, customer_dim: DataFrame) -> DataFrame:
    """Share of laundering-flagged rows by customer country."""
    return country_rate_of(_pre(fact, "CustomerSK", "IsLaundered"), customer_dim)


def country_rate_of(pre: DataFrame, customer_dim: DataFrame) -> DataFrame:
    g = (pre.join(customer_dim.select("CustomerSK", "Country").hint("merge"), "CustomerSK")
         .groupBy("Country").agg(F.sum("_w").alias("_n")))
    return _share(g, ["Country"], "LaunderingRate")


# The names under which the views are read (their spelling is the contract).
GOLD_VIEWS = {
    "account_type_launderingrate": ("fa", account_type_laundering_rate),
    "Uganda_Fraud": ("fc", country_fraud_share),
    "luandering_channel": ("fc", laundering_by_channel),
    "Country_FraudVol": ("fc", country_fraud_volume),
    "riskscore_dow": ("fc", riskscore_by_weekday),
    "luandering_account": ("fac", laundering_by_account_kyc),
    "Country_LaunderingRate": ("fc", country_laundering_rate),
}


def build_gold(fact: DataFrame, customer_dim: DataFrame, account_dim: DataFrame) -> dict[str, DataFrame]:
    """All gold views by their reference names (lazy DataFrames)."""
    out = {}
    for name, (sig, fn) in GOLD_VIEWS.items():
        if sig == "fa":
            out[name] = fn(fact, account_dim)
        elif sig == "fc":
            out[name] = fn(fact, customer_dim)
        else:
            out[name] = fn(fact, account_dim, customer_dim)
    return out
