"""Every operator as a query on the driver tables, with its DuckDB oracle.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is the
SQL that computes the same rows from the same parquet tables.  Output edge:
decimals leave as DOUBLE and integers as BIGINT so both engines agree on types.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import (ACCOUNT_DATE_PATTERNS, CUSTOMER_DATE_PATTERNS, INVALID_OPEN_DATE,
                               TRANSACTION_DATE_PATTERNS, VALID_OPEN_DATE, clean_name, parse_amount,
                               parse_date, quality_label, title_only, title_trimmed)
from ..operators import closed_form, models
from ..operators.dedup import latest_per_key
from ..operators.features import transaction_features
from ..operators.interval_index import asof_lookup_indexed
from ..operators.keys import assign_keys, in_row_order, in_test, split_hash
from ..operators.lookup import asof_lookup, current_lookup, left_lookup
from ..operators.merge import scd2_close
from ..schemas import ACCOUNT_DIM, CUSTOMER_DIM, CUSTOMER_TRACKED, FEATURE_COLUMNS, LINEAGE
from ..session import work_path
from ..sources.buckets import scd1_bucketed, scd2_bucketed, upsert_bucketed
from ..sources.raw import add_columns, backfill_nulls, read_raw, with_lineage
from ..sources.tables import alter_add_columns, append_by_name, append_table, overwrite_table, publish, read_partitions, replace_partitions
from ..streaming.incremental import load_incremental, quarantined
from . import driver, gold, incremental, silver
from .bronze import BRONZE_TABLES
from .layers import by_month
from .rejects import reject_counts, run_rejects
from .oracle import ACCT_PATTERNS, CUST_PATTERNS, cte, initcap, linear_fit, logistic_fit, parse, share2, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: edge(fn(spark, sf_dir))
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def edge(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, T.DecimalType) or isinstance(t, T.FloatType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("long").alias(f.name))
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


S = driver.silver_tables  # materialized silver layer per (application, folder)
FACT_OUT = ("TransactionID, CustomerSK, AccountSK, TransactionDate, CAST(Amount AS DOUBLE) AS Amount, "
            "TransactionType, Channel, DestinationCountry, IsFraud, IsLaundered, CAST(RiskScore AS BIGINT) AS RiskScore")

# ============================ cleaning (D1-D5, F1-F7) ==========================


@register("parse_dates", sql(f"""
SELECT TransactionID, TransactionDate AS DateText,
  {parse('TransactionDate', ACCT_PATTERNS)} AS ParsedDate,
  {parse('TransactionDate', CUST_PATTERNS, trim=True)} AS CustomerPatternDate
FROM t_raw""", "t_raw"))
def q_parse_dates(spark, d):
    raw = driver.transaction_raw(spark, d)
    return raw.select("TransactionID", F.col("TransactionDate").alias("DateText"),
                      parse_date("TransactionDate", TRANSACTION_DATE_PATTERNS).alias("ParsedDate"),
                      parse_date("TransactionDate", CUSTOMER_DATE_PATTERNS, trim=True).alias("CustomerPatternDate"))


@register("quality_flag", sql(f"""
SELECT AccountID, OpenDate AS OpenDateText, {parse('OpenDate', ACCT_PATTERNS)} AS OpenDate,
  CASE WHEN {parse('OpenDate', ACCT_PATTERNS)} IS NULL THEN 'InvalidOpenDate' ELSE 'ValidOpenDate' END AS QualityCheck
FROM a_raw""", "a_raw"))
def q_quality_flag(spark, d):
    raw = driver.account_raw(spark, d)
    parsed = raw.select("AccountID", F.col("OpenDate").alias("OpenDateText"),
                        parse_date("OpenDate", ACCOUNT_DATE_PATTERNS).alias("OpenDate"))
    return parsed.withColumn("QualityCheck", quality_label("OpenDate", VALID_OPEN_DATE, INVALID_OPEN_DATE))


@register("parse_amount", sql("""
SELECT TransactionID, Amount AS AmountText,
  CAST(try_cast(replace(Amount, ',', '') AS DECIMAL(10,2)) AS DOUBLE) AS Amount
FROM t_raw""", "t_raw"))
def q_parse_amount(spark, d):
    raw = driver.transaction_raw(spark, d)
    return raw.select("TransactionID", F.col("Amount").alias("AmountText"), parse_amount("Amount").alias("Amount"))


@register("clean_text", sql(f"""
SELECT CAST(a.c_custkey AS VARCHAR) AS CustomerID, replace(a.CustomerName, '@', '') AS CustomerName,
  {initcap('trim(a.Country)')} AS Country, {initcap('r.Currency')} AS Currency
FROM c_attr a JOIN a_raw r ON CAST(a.c_custkey AS VARCHAR) = r.CustomerID""", "c_attr", "a_raw"))
def q_clean_text(spark, d):
    a = driver.customer_attrs(spark, d)
    r = driver.account_raw(spark, d).select(F.col("CustomerID").alias("_c"), "Currency")
    j = a.join(r.hint("merge"), a.c_custkey.cast("string") == F.col("_c"))
    return j.select(F.col("c_custkey").cast("string").alias("CustomerID"),
                    clean_name("CustomerName").alias("CustomerName"),
                    title_trimmed("Country").alias("Country"), title_only("Currency").alias("Currency"))


@register("typed_fact", sql(f"SELECT {FACT_OUT} FROM fact", "fact"))
def q_typed_fact(spark, d):
    """The fact job itself, over the published dimensions."""
    s = S(spark, d)
    return silver.fact_job(None, s.transaction_raw, s.customer_dim, s.account_dim)


# ============================ sources (S1-S10) =================================


@register("csv_roundtrip", """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey
FROM nation""")
def q_csv_roundtrip(spark, d):
    path = work_path(spark, "nation-csv")
    driver.table(spark, d, "nation").write.option("header", True).csv(path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("n_nationkey", "n_name", "n_regionkey")])
    return read_raw(spark, path, schema)


@register("bronze_lineage", sql("""
SELECT CustomerID, CustomerName, Country, RiskCategory, KYCStatus, Occupation, EffectiveDate,
  'driver/orders' AS SourceFile, true AS HasIngestionDate
FROM c_obs""", "c_obs"))
def q_bronze_lineage(spark, d):
    out = with_lineage(driver.customer_observations(spark, d).drop("_true_date"), driver.ORDERS_SOURCE)
    return out.withColumn("HasIngestionDate", F.col("IngestionDate").isNotNull()).drop("IngestionDate")


@register("schema_evolve", sql("""
SELECT AccountID, CustomerID, AccountType, Currency, OpenDate,
  CAST(NULL AS VARCHAR) AS IngestionDate, CAST(NULL AS VARCHAR) AS SourceFile
FROM a_raw""", "a_raw"))
def q_schema_evolve(spark, d):
    return add_columns(driver.account_raw(spark, d), LINEAGE)


@register("backfill_nulls", sql("""
SELECT AccountID, CustomerID, AccountType, Currency, OpenDate,
  '2001-09-01 00:00:00' AS IngestionDate, 'driver/customer' AS SourceFile
FROM a_raw""", "a_raw"))
def q_backfill_nulls(spark, d):
    evolved = add_columns(driver.account_raw(spark, d), LINEAGE)
    return backfill_nulls(evolved, {"IngestionDate": F.lit(driver.BATCH2_INGESTED).cast("timestamp"),
                                    "SourceFile": "driver/customer"}, guard="IngestionDate")


@register("incremental_load", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders""")
def q_incremental_load(spark, d):
    """Two file drops into a landing folder, each followed by an availableNow
    run; the second run must load only the new files."""
    orders = driver.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                      "o_orderpriority", "o_orderdate")
    landing, target, ckpt = (work_path(spark, x) for x in ("landing", "bronze-orders", "bronze-orders-ckpt"))
    early = F.col("o_orderdate") < F.lit(driver.BATCH_SPLIT_DATE).cast("timestamp_ntz")
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"
    orders.where(early).select(*cols).write.option("header", True).csv(f"{landing}/drop=1")
    load_incremental(spark, landing, schema, target, ckpt, recursive=True)
    orders.where(~early).select(*cols).write.option("header", True).csv(f"{landing}/drop=2")
    return load_incremental(spark, landing, schema, target, ckpt, recursive=True).select(*cols)


# ============================ dedup (W1-W3, P4, D3, O5) ========================


@register("dedup_latest", sql("""
SELECT CustomerID, CustomerName, Country, RiskCategory, KYCStatus, Occupation, EffectiveDate,
  QualityCheck, rn FROM c_ranked2 WHERE rn = 1""", "c_ranked2"))
def q_dedup_latest(spark, d):
    s = S(spark, d)
    staged = silver.stage_customers(s.customer_raw[2])
    return latest_per_key(staged, ["CustomerID"], ["IngestionDate", "EffectiveDate"]).drop("IngestionDate")


@register("dedup_valid", sql("""
SELECT CustomerID, CustomerName, Country, RiskCategory, KYCStatus, Occupation, EffectiveDate,
  QualityCheck, rn FROM c_ranked2 WHERE rn = 1 AND QualityCheck = 'ValidDate'""", "c_ranked2"))
def q_dedup_valid(spark, d):
    s = S(spark, d)
    return silver.dedup_customers(silver.stage_customers(s.customer_raw[2])).drop("IngestionDate")


@register("dedup_fact", sql("""
SELECT TransactionID, CustomerSK, AccountSK, TransactionDate, CAST(Amount AS DOUBLE) AS Amount,
  asof_start AS StartDate, rn FROM t_dedup""", "t_dedup"))
def q_dedup_fact(spark, d):
    s = S(spark, d)
    staged = silver.stage_transactions(s.transaction_raw, s.customer_dim, s.account_dim)
    dd = silver.dedup_transactions(staged)
    return dd.select("TransactionID", "CustomerSK", "AccountSK", "TransactionDate", "Amount",
                     F.col("_asof_start").alias("StartDate"), "rn")


# ============================ keys and merges (S12-S16) ========================


@register("surrogate_keys", """
SELECT row_number() OVER (ORDER BY c_custkey) AS CustomerSK, c_custkey, c_name FROM customer""")
def q_surrogate_keys(spark, d):
    c = driver.table(spark, d, "customer").select("c_custkey", "c_name")
    return assign_keys(c, ["c_custkey"], "CustomerSK")


@register("scd2_merge", sql("SELECT * FROM dim2", "dim2"))
def q_scd2_merge(spark, d):
    """The third customer run itself, over the published second one: it stages the third load only."""
    s = S(spark, d)
    return silver.customer_job(s.customer_dim_1, s.customer_raw[2], since=driver.BATCH1_INGESTED)


@register("scd2_close", sql("SELECT * FROM dim1_closed", "dim1_closed"))
def q_scd2_close(spark, d):
    s = S(spark, d)
    src = silver.dedup_customers(silver.stage_customers(silver.newer_loads(s.customer_raw[2], driver.BATCH1_INGESTED)))
    return scd2_close(s.customer_dim_1, src, "CustomerID", CUSTOMER_TRACKED)


cte("a_raw_b1", ("a_raw",), """
SELECT AccountID, CustomerID, AccountType, Currency, OpenDate FROM a_raw
WHERE CustomerID IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')""")
cte("a_raw_b2", ("a_raw",), """
SELECT AccountID, CustomerID, lower(AccountType) AS AccountType, Currency, OpenDate FROM a_raw""")


def _a_stage_from(src: str) -> str:
    from .oracle import _a_stage
    return _a_stage(src)


def _a_dedup_from(src: str) -> str:
    from .oracle import _a_dedup
    return _a_dedup(src)


cte("a_stage_b1", ("a_raw_b1", "dim2"), _a_stage_from("a_raw_b1"))
cte("a_src_b1", ("a_stage_b1",), _a_dedup_from("a_stage_b1"))
cte("acct_b1", ("a_src_b1",), """
SELECT row_number() OVER (ORDER BY AccountID) AS AccountSK, AccountID, CustomerSK, AccountType, Currency, OpenDate
FROM a_src_b1""")
cte("a_stage_b2", ("a_raw_b2", "dim2"), _a_stage_from("a_raw_b2"))
cte("a_src_b2", ("a_stage_b2",), _a_dedup_from("a_stage_b2"))
cte("acct_merged", ("acct_b1", "a_src_b2"), """
SELECT t.AccountSK, t.AccountID,
  CASE WHEN s.AccountID IS NOT NULL THEN s.CustomerSK ELSE t.CustomerSK END AS CustomerSK,
  CASE WHEN s.AccountID IS NOT NULL THEN s.AccountType ELSE t.AccountType END AS AccountType,
  CASE WHEN s.AccountID IS NOT NULL THEN s.Currency ELSE t.Currency END AS Currency,
  CASE WHEN s.AccountID IS NOT NULL THEN s.OpenDate ELSE t.OpenDate END AS OpenDate
FROM acct_b1 t LEFT JOIN a_src_b2 s ON t.AccountID = s.AccountID
UNION ALL
SELECT (SELECT coalesce(max(AccountSK), 0) FROM acct_b1) + row_number() OVER (ORDER BY s.AccountID),
  s.AccountID, s.CustomerSK, s.AccountType, s.Currency, s.OpenDate
FROM a_src_b2 s WHERE s.AccountID NOT IN (SELECT AccountID FROM acct_b1)""")


@register("scd1_merge", sql("SELECT * FROM acct_merged", "acct_merged"))
def q_scd1_merge(spark, d):
    """First delivery: accounts of customers who ordered before 1996; second
    delivery: every account, with re-spelled account types (updates + inserts)."""
    s = S(spark, d)
    raw = driver.account_raw(spark, d)
    early = (driver.table(spark, d, "orders").where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
             .select(F.col("o_custkey").cast("string").alias("CustomerID")))
    b1 = raw.join(early.hint("merge"), "CustomerID", "left_semi")
    b2 = raw.withColumn("AccountType", F.lower("AccountType"))
    target = silver.account_job(None, b1, s.customer_dim)
    return silver.account_job(target, b2, s.customer_dim)


def _t_chain(prefix: str, src_filter: str, risk: str = "RiskScore") -> None:
    from .oracle import _t_dedup, _t_parsed, _t_staged, _t_typed
    cte(f"{prefix}_raw", ("t_raw",), f"""
SELECT TransactionID, CustomerID, AccountID, TransactionDate, Amount, TransactionType, Channel,
  DestinationCountry, IsFraud, IsLaundered, {risk} AS RiskScore, true_date FROM t_raw WHERE {src_filter}""")
    cte(f"{prefix}_parsed", (f"{prefix}_raw",), _t_parsed(f"{prefix}_raw"))
    cte(f"{prefix}_staged", (f"{prefix}_parsed", "dim2", "acct"), _t_staged(f"{prefix}_parsed"))
    cte(f"{prefix}_dedup", (f"{prefix}_staged",), _t_dedup(f"{prefix}_staged"))
    cte(f"{prefix}_fact", (f"{prefix}_dedup",), _t_typed(f"{prefix}_dedup"))


_t_chain("tb1", "true_date < DATE '1998-01-01'")
_t_chain("tb2", "true_date >= DATE '1997-07-01'", risk="RiskScore || '0'")
cte("fact_merged", ("tb1_fact", "tb2_fact"), """
SELECT * FROM tb1_fact WHERE TransactionID NOT IN (SELECT TransactionID FROM tb2_fact)
UNION ALL SELECT * FROM tb2_fact""")


cte("march", ("tb1_fact",), """
SELECT TransactionID FROM tb1_fact WHERE strftime(TransactionDate, '%Y-%m') = '1996-03'""")
cte("tm2_raw", ("t_raw", "march"), """
SELECT TransactionID, CustomerID, AccountID, TransactionDate, Amount, TransactionType, Channel, DestinationCountry,
  IsFraud, IsLaundered, RiskScore || '0' AS RiskScore, true_date FROM t_raw
WHERE true_date >= DATE '1997-07-01' AND (TransactionID IS NULL OR TransactionID NOT IN (SELECT TransactionID FROM march))
UNION ALL
SELECT TransactionID, CustomerID, AccountID, '04/01/1997', Amount, TransactionType, Channel, DestinationCountry,
  IsFraud, IsLaundered, RiskScore || '0', true_date FROM t_raw
WHERE true_date < DATE '1998-01-01' AND TransactionID IN (SELECT TransactionID FROM march)""")


def _tm2() -> None:
    from .oracle import _t_dedup, _t_parsed, _t_staged, _t_typed
    cte("tm2_parsed", ("tm2_raw",), _t_parsed("tm2_raw"))
    cte("tm2_staged", ("tm2_parsed", "dim2", "acct"), _t_staged("tm2_parsed"))
    cte("tm2_dedup", ("tm2_staged",), _t_dedup("tm2_staged"))
    cte("tm2_fact", ("tm2_dedup",), _t_typed("tm2_dedup"))


_tm2()
cte("moved_merged", ("tb1_fact", "tm2_fact"), """
SELECT * FROM tb1_fact WHERE TransactionID NOT IN (SELECT TransactionID FROM tm2_fact)
UNION ALL SELECT * FROM tm2_fact""")


@register("fact_upsert", sql(f"SELECT {FACT_OUT} FROM fact_merged", "fact_merged"))
def q_fact_upsert(spark, d):
    s = S(spark, d)
    raw = driver.transaction_raw(spark, d, keep_true_date=True)
    b1 = raw.where(F.col("_true_date") < F.lit("1998-01-01").cast("date")).drop("_true_date")
    b2 = (raw.where(F.col("_true_date") >= F.lit("1997-07-01").cast("date")).drop("_true_date")
          .withColumn("RiskScore", F.concat("RiskScore", F.lit("0"))))
    target = silver.fact_job(None, b1, s.customer_dim, s.account_dim)
    return silver.fact_job(target, b2, s.customer_dim, s.account_dim)


# ============================ lookups (J1-J3, P10) =============================


@register("current_lookup", sql("""
SELECT r.AccountID, r.CustomerID, c.CustomerSK, c.KYCStatus
FROM a_raw r LEFT JOIN (SELECT * FROM dim2 WHERE IsCurrent) c ON r.CustomerID = c.CustomerID""", "a_raw", "dim2"))
def q_current_lookup(spark, d):
    s = S(spark, d)
    raw = driver.account_raw(spark, d).select("AccountID", "CustomerID")
    return current_lookup(raw, s.customer_dim, "CustomerID", ["CustomerSK", "KYCStatus"])


@register("asof_lookup", sql("""
SELECT p.TransactionID, p.TransactionDate, c.CustomerSK, c.StartDate
FROM t_parsed p LEFT JOIN dim2 c ON p.CustomerID = c.CustomerID AND p.TransactionDate >= c.StartDate
  AND (p.TransactionDate <= c.EndDate OR c.EndDate IS NULL)""", "t_parsed", "dim2"))
def q_asof_lookup(spark, d):
    s = S(spark, d)
    parsed = silver.parse_transactions(s.transaction_raw).select("TransactionID", "CustomerID", "TransactionDate")
    j = asof_lookup(parsed, s.customer_dim, "CustomerID", "TransactionDate", ["CustomerSK"])
    return j.select("TransactionID", "TransactionDate", "CustomerSK", F.col("_asof_start").alias("StartDate"))


cte("nation_orders", (), """
SELECT o_orderkey, c_nationkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders JOIN customer ON o_custkey = c_custkey""")
cte("nation_versions", ("nation_orders",), """
SELECT k, d AS StartDate, lead(d) OVER (PARTITION BY k ORDER BY d) AS EndDate, n AS Orders
FROM (SELECT k, d, count(*) AS n FROM nation_orders GROUP BY k, d)""")


@register("asof_many_versions", sql("""
SELECT o.o_orderkey, o.QueryDate, v.StartDate, v.Orders FROM (
  SELECT o_orderkey, k, d + CAST(o_orderkey % 41 - 20 AS INTEGER) AS QueryDate FROM nation_orders) o
LEFT JOIN nation_versions v ON v.k = o.k AND o.QueryDate >= v.StartDate AND (o.QueryDate <= v.EndDate OR v.EndDate IS NULL)""",
                                    "nation_orders", "nation_versions"))
def q_asof_many_versions(spark, d):
    """As-of lookup where every key (a nation) has a version for each day with orders: hundreds
    to thousands of versions and a fact for each order, up to 20 days off its date."""
    o, c = driver.table(spark, d, "orders"), driver.table(spark, d, "customer")
    rows = o.join(c.hint("merge"), o.o_custkey == c.c_custkey).select("o_orderkey", F.col("c_nationkey").alias("k"), F.col("o_orderdate").cast("date").alias("d"))
    per_day = rows.groupBy("k", "d").agg(F.count("*").alias("Orders"))
    versions = per_day.select("k", F.col("d").alias("StartDate"), F.lead("d").over(Window.partitionBy("k").orderBy("d")).alias("EndDate"), "Orders")
    facts = rows.select("o_orderkey", "k", F.date_add("d", (F.pmod("o_orderkey", F.lit(41)) - 20).cast("int")).alias("QueryDate"))
    found = asof_lookup_indexed(facts, versions, "k", "QueryDate", ["Orders"])
    return found.select("o_orderkey", "QueryDate", F.col("_asof_start").alias("StartDate"), "Orders")


@register("left_lookup", sql("""
SELECT p.TransactionID, p.AccountID, a.AccountSK FROM t_parsed p LEFT JOIN acct a ON p.AccountID = a.AccountID""",
                             "t_parsed", "acct"))
def q_left_lookup(spark, d):
    s = S(spark, d)
    parsed = silver.parse_transactions(s.transaction_raw).select("TransactionID", "AccountID")
    return left_lookup(parsed, s.account_dim, "AccountID", ["AccountSK"])


@register("stage_fact", sql("""
SELECT TransactionID, CustomerSK, AccountSK, TransactionDate, CAST(Amount AS DOUBLE) AS Amount,
  asof_start AS StartDate FROM t_staged""", "t_staged"))
def q_stage_fact(spark, d):
    s = S(spark, d)
    st = silver.stage_transactions(s.transaction_raw, s.customer_dim, s.account_dim)
    return st.select("TransactionID", "CustomerSK", "AccountSK", "TransactionDate", "Amount",
                     F.col("_asof_start").alias("StartDate"))


# ============================ gold (A1-A9, J4, J5, G1-G7) ======================

_SHARE = share2("n", "sum(n) OVER ()")


@register("share_by_one_key", sql(f"""
SELECT AccountType, {_SHARE} AS LaunderingRate FROM (
  SELECT a.AccountType, count(f.IsLaundered) AS n FROM fact f JOIN acct a ON f.AccountSK = a.AccountSK
  GROUP BY a.AccountType)""", "fact", "acct"))
def q_share_by_one_key(spark, d):
    s = S(spark, d)
    return gold.account_type_laundering_rate(s.fact, s.account_dim)


@register("share_filtered", sql(f"""
SELECT Country, IsFraud, {_SHARE} AS RiskCategoryRate FROM (
  SELECT c.Country, f.IsFraud, count(f.IsFraud) AS n FROM fact f JOIN dim2 c ON f.CustomerSK = c.CustomerSK
  WHERE c.Country <> 'Nation_1' GROUP BY c.Country, f.IsFraud)""", "fact", "dim2"))
def q_share_filtered(spark, d):
    s = S(spark, d)
    return gold.country_fraud_share(s.fact, s.customer_dim, excluded=driver.DRIVER_EXCLUDED_COUNTRY)


@register("share_by_two_keys", sql(f"""
SELECT Channel, KYCStatus, {_SHARE} AS LaunderingRate FROM (
  SELECT f.Channel, c.KYCStatus, count(f.IsLaundered) AS n FROM fact f JOIN dim2 c ON f.CustomerSK = c.CustomerSK
  GROUP BY c.KYCStatus, f.Channel)""", "fact", "dim2"))
def q_share_by_two_keys(spark, d):
    s = S(spark, d)
    return gold.laundering_by_channel(s.fact, s.customer_dim)


@register("group_count", sql("""
SELECT c.Country, f.IsFraud, count(f.IsFraud) AS FraudCount
FROM fact f JOIN dim2 c ON f.CustomerSK = c.CustomerSK GROUP BY c.Country, f.IsFraud""", "fact", "dim2"))
def q_group_count(spark, d):
    s = S(spark, d)
    return gold.country_fraud_volume(s.fact, s.customer_dim)


@register("avg_by_dow", sql("""
SELECT c.CustomerName AS Name, strftime(f.TransactionDate, '%a') AS DayOfWeek,
  round(avg(f.RiskScore)) AS AvgRiskScore
FROM fact f JOIN dim2 c ON f.CustomerSK = c.CustomerSK
GROUP BY c.CustomerName, strftime(f.TransactionDate, '%a')""", "fact", "dim2"))
def q_avg_by_dow(spark, d):
    s = S(spark, d)
    return gold.riskscore_by_weekday(s.fact, s.customer_dim)


@register("share_three_way", sql(f"""
SELECT AccountType, KYCStatus, {_SHARE} AS LaunderingRate FROM (
  SELECT a.AccountType, c.KYCStatus, count(f.IsLaundered) AS n FROM fact f
  JOIN acct a ON f.AccountSK = a.AccountSK JOIN dim2 c ON a.CustomerSK = c.CustomerSK
  GROUP BY a.AccountType, c.KYCStatus)""", "fact", "acct", "dim2"))
def q_share_three_way(spark, d):
    s = S(spark, d)
    return gold.laundering_by_account_kyc(s.fact, s.account_dim, s.customer_dim)


@register("share_by_country", sql(f"""
SELECT Country, {_SHARE} AS LaunderingRate FROM (
  SELECT c.Country, count(f.IsLaundered) AS n FROM fact f JOIN dim2 c ON f.CustomerSK = c.CustomerSK
  GROUP BY c.Country)""", "fact", "dim2"))
def q_share_by_country(spark, d):
    s = S(spark, d)
    return gold.country_laundering_rate(s.fact, s.customer_dim)


# ============================ features (M1, W4-W6, F10, J6) ====================

def rounded_ratio(f: DataFrame) -> DataFrame:
    """The ratio as it leaves a query; the models read it in full."""
    return f.withColumn("Amount_vs_Avg", F.round("Amount_vs_Avg", 6).cast("double"))


def feature_view(spark: SparkSession, d: str) -> DataFrame:
    """The feature view over the silver snapshots (lazy)."""
    s = S(spark, d)
    return rounded_ratio(transaction_features(s.fact, s.customer_dim, home=driver.DRIVER_HOME_COUNTRY))


_FEATURES: dict[tuple[str, str], tuple[object, DataFrame]] = {}


def features(spark: SparkSession, d: str) -> DataFrame:
    """The feature table, published once per silver build and read by every
    consumer (rolling analytics, trend, the three model jobs)."""
    key, layer = (spark.sparkContext.applicationId, d.rstrip("/")), S(spark, d)
    if key not in _FEATURES or _FEATURES[key][0] is not layer:
        view = transaction_features(layer.fact, layer.customer_dim, home=driver.DRIVER_HOME_COUNTRY)
        _FEATURES[key] = (layer, publish(view, name="transaction_features"))
    return _FEATURES[key][1]


@register("features", sql("SELECT * FROM features", "features"))
def q_features(spark, d):
    return feature_view(spark, d)


def _feature_pick(name: str, col: str) -> None:
    register(name, sql(f"SELECT TransactionID, CustomerSK, TransactionDate, {col} FROM features", "features"))(
        lambda spark, d: feature_view(spark, d).select("TransactionID", "CustomerSK", "TransactionDate", col))


_feature_pick("rolling_count_7d", "TxnCount_Last_7_Days")
_feature_pick("rolling_avg_30d", "AvgAmount_Last_30_Days")
_feature_pick("ratio_to_avg", "Amount_vs_Avg")
_feature_pick("tenure_days", "CustomerTenure")

# ============================ trend, preview, split (M14-M16, O2-O4, M2) ========

cte("daily", ("features",), """
SELECT TransactionDate AS Date, count(CASE WHEN IsFraud THEN 1 END) AS FraudVolume FROM features GROUP BY TransactionDate""")
cte("daily_ix", ("daily",), """
SELECT *, row_number() OVER (ORDER BY Date ASC NULLS LAST) - 1 AS DayIndex FROM daily""")


@register("daily_flag_volume", sql("SELECT * FROM daily", "daily"))
def q_daily_flag_volume(spark, d):
    return models.daily_flag_volume(features(spark, d))


@register("daily_trend", sql("""
SELECT Date, FraudVolume, DayIndex,
  round((SELECT regr_intercept(FraudVolume, DayIndex) FROM daily_ix)
        + (SELECT regr_slope(FraudVolume, DayIndex) FROM daily_ix) * DayIndex, 6) AS Predicted
FROM daily_ix""", "daily_ix"))
def q_daily_trend(spark, d):
    return models.trend_predictions(models.with_day_index(models.daily_flag_volume(features(spark, d))))


@register("daily_trend_fit", sql("""
SELECT round(regr_slope(FraudVolume, DayIndex), 6) AS slope, round(regr_intercept(FraudVolume, DayIndex), 6) AS intercept,
  round(regr_r2(FraudVolume, DayIndex), 6) AS r2, count(*) AS days FROM daily_ix""", "daily_ix"))
def q_daily_trend_fit(spark, d):
    return models.trend_fit(models.with_day_index(models.daily_flag_volume(features(spark, d))))


@register("top_n_preview", sql("""
SELECT TransactionID, Amount, RiskScore FROM features ORDER BY Amount DESC, TransactionID LIMIT 10""", "features"))
def q_top_n_preview(spark, d):
    f = features(spark, d)
    return f.orderBy(F.col("Amount").desc(), F.col("TransactionID")).limit(10).select(
        "TransactionID", "Amount", "RiskScore")


@register("hash_split", """
SELECT o_orderkey, ('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT AS Hash,
  ('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT >= 858993459 AS IsTrain
FROM orders""")
def q_hash_split(spark, d):
    o = driver.table(spark, d, "orders").select("o_orderkey")
    return o.select("o_orderkey", split_hash("o_orderkey", seed=42).alias("Hash"),
                    (~in_test("o_orderkey", seed=42, test_fraction=0.2)).alias("IsTrain"))


# ============================ metrics (M6-M8, M12) =============================

cte("lab", (), "SELECT doc_id, toxic AS Actual, 1 - quality AS Predicted FROM labels")
cte("lab_counts", ("lab",), """
SELECT count(*) FILTER (WHERE Actual = 1 AND Predicted = 1) AS tp, count(*) FILTER (WHERE Actual = 0 AND Predicted = 1) AS fp,
  count(*) FILTER (WHERE Actual = 1 AND Predicted = 0) AS fn, count(*) FILTER (WHERE Actual = 0 AND Predicted = 0) AS tn
FROM lab""")


def _labels(spark, d):
    lab = driver.table(spark, d, "labels")
    return lab.select("doc_id", F.col("toxic").alias("Actual"), (1 - F.col("quality")).alias("Predicted"))


@register("classification_accuracy", sql("""
SELECT (count(*) FILTER (WHERE Actual = Predicted))::DOUBLE / count(*) AS accuracy, count(*) AS n FROM lab""", "lab"))
def q_accuracy(spark, d):
    return models.accuracy(_labels(spark, d))


@register("confusion_matrix", sql("""
SELECT CAST(Actual AS BIGINT) AS Actual, count(*) FILTER (WHERE Predicted = 0) AS Predicted0, count(*) FILTER (WHERE Predicted = 1) AS Predicted1
FROM lab GROUP BY Actual""", "lab"))
def q_confusion(spark, d):
    return models.confusion_matrix(_labels(spark, d))


def _d(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


cte("lab_m", ("lab_counts",), f"""
SELECT {_d('tp', 'tp + fp')} AS p1, {_d('tp', 'tp + fn')} AS r1, tp + fn AS s1,
  {_d('tn', 'tn + fn')} AS p0, {_d('tn', 'tn + fp')} AS r0, tn + fp AS s0,
  {_d('tp + tn', 'tp + tn + fp + fn')} AS acc FROM lab_counts""")
cte("lab_f", ("lab_m",), f"""
SELECT *, {_d('2 * p1 * r1', 'p1 + r1')} AS f1, {_d('2 * p0 * r0', 'p0 + r0')} AS f0 FROM lab_m""")


@register("classification_report", sql(f"""
SELECT '0' AS label, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0 AS support FROM lab_f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM lab_f
UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), s0 + s1 FROM lab_f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), s0 + s1 FROM lab_f
UNION ALL SELECT 'weighted avg', round({_d('p0 * s0 + p1 * s1', 's0 + s1')}, 6), round({_d('r0 * s0 + r1 * s1', 's0 + s1')}, 6),
  round({_d('f0 * s0 + f1 * s1', 's0 + s1')}, 6), s0 + s1 FROM lab_f""", "lab_f"))
def q_report(spark, d):
    return models.classification_report(_labels(spark, d))


@register("r2_score", sql("""
SELECT round(1 - sum((RiskScore - (45 + 10 * IsForeignTransaction)) ^ 2)
  / sum((RiskScore - (SELECT avg(RiskScore) FROM features)) ^ 2), 6) AS r2, count(*) AS n FROM features""", "features"))
def q_r2(spark, d):
    f = features(spark, d).select(F.col("RiskScore").cast("double").alias("y"),
                                  (45 + 10 * F.col("IsForeignTransaction")).cast("double").alias("p"))
    r = models.r2_score(f, "y", "p")
    return r.select(F.round("r2", 6).alias("r2"), "n")


# ============================ models (M3-M5, M9-M13, M17) ======================

SPLIT_TEST = "('0x' || substr(md5('42:' || TransactionID), 1, 8))::BIGINT < 858993459"
SCORABLE = " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLUMNS)
_INPUTS = len(FEATURE_COLUMNS)


def _blocks(steps: list[str], *deps: str) -> None:
    """Register written-out CTEs; each needs the one before it."""
    last = deps
    for step in steps:
        name, computed, body = re.fullmatch(r"(\w+) AS (MATERIALIZED )?\((.*)\)", step, re.S).groups()
        cte(name, last, body, bool(computed))
        last = (*deps, name)


def _model_rows(name: str, label: str, kind: str) -> None:
    """Labelled rows with complete inputs (``name``_train without the test rows), inputs with six decimals."""
    inputs = ", ".join(f"CAST({c} AS DECIMAL(18,6)){kind} AS c{i}" for i, c in enumerate(FEATURE_COLUMNS))
    cte(name, ("features",), f"""
SELECT TransactionID, CAST({label} AS BIGINT) AS Actual, CAST({label} AS BIGINT)::DOUBLE AS y, CAST(CAST({label} AS BIGINT) AS DECIMAL(18,6)) AS c{_INPUTS},
  {inputs}, {SCORABLE} AS Usable, {SPLIT_TEST} AS InTest FROM features WHERE {label} IS NOT NULL""", computed=True)
    cte(f"{name}_train", (name,), f"SELECT * FROM {name} WHERE Usable AND NOT InTest")


_model_rows("risk_rows", "RiskScore", "")
_model_rows("fraud_rows", "IsFraud", "::DOUBLE")
_blocks(linear_fit("risk_rows_train", FEATURE_COLUMNS), "risk_rows_train")
_blocks(logistic_fit("fraud_rows_train", FEATURE_COLUMNS, closed_form.NEWTON_STEPS), "fraud_rows_train")
cte("risk_predictions", ("risk_rows", "ols"), f"""
SELECT TransactionID, Actual::DOUBLE AS ActualRiskScore,
  CASE WHEN Usable THEN round(icept{''.join(f' + x{i} * CAST(c{i} AS DOUBLE)' for i in range(_INPUTS))}, 4) END AS PredictedRiskScore
FROM risk_rows, ols WHERE InTest""")
cte("fraud_scores", ("fraud_rows", "logit"), f"""
SELECT TransactionID, Actual, Usable, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(w0{''.join(f' + w{i + 1} * c{i}' for i in range(_INPUTS))}))) AS p
FROM fraud_rows, logit WHERE InTest""")
cte("fraud_predictions", ("fraud_scores",), """
SELECT TransactionID, Actual, CASE WHEN Usable THEN CAST(p > 0.5 AS BIGINT) END AS Predicted, CASE WHEN Usable THEN round(p, 4) END AS PredictedProb
FROM fraud_scores""")


def fraud_fit(spark: SparkSession, d: str):
    train, test = models.split_for_models(models.model_input(features(spark, d), "IsFraud"))
    return closed_form.fit_logistic(train), test


def risk_fit(spark: SparkSession, d: str):
    train, test = models.split_for_models(models.model_input(features(spark, d), "RiskScore"))
    return closed_form.fit_linear(train), test


@register("fraud_classifier", sql("SELECT * FROM fraud_predictions", "fraud_predictions"))
def q_fraud_classifier(spark, d):
    """The prediction table of the logistic fit."""
    return closed_form.logistic_predictions(*fraud_fit(spark, d))


@register("risk_regressor", sql("SELECT * FROM risk_predictions", "risk_predictions"))
def q_risk_regressor(spark, d):
    """The prediction table of the linear fit."""
    return closed_form.linear_predictions(*risk_fit(spark, d))


@register("model_metrics", sql("""
SELECT 'classifier_accuracy' AS metric, round(avg(CAST(Actual = Predicted AS BIGINT)), 6) AS value FROM fraud_predictions
UNION ALL SELECT 'regressor_r2', round(1 - sum((ActualRiskScore - PredictedRiskScore) ^ 2) / (var_pop(ActualRiskScore) * count(*)), 6)
  FROM risk_predictions WHERE PredictedRiskScore IS NOT NULL
UNION ALL SELECT 'trend_r2', round(regr_r2(FraudVolume, DayIndex), 6) FROM daily_ix""", "fraud_predictions", "risk_predictions", "daily_ix"))
def q_model_metrics(spark, d):
    """One (metric, value) row per run: classifier accuracy, regressor R², trend R²."""
    pc = closed_form.logistic_predictions(*fraud_fit(spark, d))
    pr = closed_form.linear_predictions(*risk_fit(spark, d))
    trend = models.trend_fit(models.with_day_index(models.daily_flag_volume(features(spark, d))))
    acc = models.accuracy(pc).select(F.lit("classifier_accuracy").alias("metric"), F.round("accuracy", 6).alias("value"))
    r2 = models.r2_score(pr, "ActualRiskScore", "PredictedRiskScore").select(
        F.lit("regressor_r2").alias("metric"), F.round("r2", 6).alias("value"))
    return acc.unionByName(r2).unionByName(trend.select(F.lit("trend_r2").alias("metric"), F.col("r2").alias("value")))


def _fit_rows(model: str, source: str, names) -> str:
    return " UNION ALL ".join(f"SELECT '{model}' AS model, '{f}' AS feature, round({x}, 4) AS coefficient FROM {source}" for f, x in names)


@register("model_coefficients", sql(
    _fit_rows("IsFraud", "logit", [*((c, f"w{i + 1}") for i, c in enumerate(FEATURE_COLUMNS)), ("Intercept", "w0")]) + " UNION ALL "
    + _fit_rows("RiskScore", "ols", [*((c, f"x{i}") for i, c in enumerate(FEATURE_COLUMNS)), ("Intercept", "icept")]), "logit", "ols"))
def q_model_coefficients(spark, d):
    """Coefficient per input (4 digits) and intercept of both fits."""
    parts = [closed_form.fit_table(spark, fit(spark, d)[0]).withColumn("model", F.lit(m)) for m, fit in (("IsFraud", fraud_fit), ("RiskScore", risk_fit))]
    return parts[0].unionByName(parts[1])


@register("fraud_test_rows", sql(f"""
SELECT TransactionID, CAST(IsFraud AS BIGINT) AS Actual, {SCORABLE} AS HasPrediction FROM features
WHERE IsFraud IS NOT NULL AND {SPLIT_TEST}""", "features"))
def q_fraud_test_rows(spark, d):
    """The classifier's prediction table: every labelled test row, scored where its inputs are complete."""
    inp = models.model_input(features(spark, d), "IsFraud")
    train, test = models.split_for_models(inp)
    pred = models.classifier_predictions(models.fit_classifier(train), test)
    return pred.select("TransactionID", "Actual", (F.col("Predicted").isNotNull() & F.col("PredictedProb").isNotNull()).alias("HasPrediction"))


@register("risk_test_rows", sql(f"""
SELECT TransactionID, CAST(RiskScore AS DOUBLE) AS ActualRiskScore, {SCORABLE} AS HasPrediction FROM features
WHERE RiskScore IS NOT NULL AND {SPLIT_TEST}""", "features"))
def q_risk_test_rows(spark, d):
    """The regressor's prediction table, like ``fraud_test_rows``."""
    inp = models.model_input(features(spark, d), "RiskScore")
    train, test = models.split_for_models(inp)
    pred = models.regressor_predictions(models.fit_regressor(train), test)
    return pred.select("TransactionID", "ActualRiskScore", F.col("PredictedRiskScore").isNotNull().alias("HasPrediction"))


@register("fit_gradients", f"""
SELECT m AS model, i AS input, 0.0::DOUBLE AS gradient FROM (SELECT unnest(['IsFraud', 'RiskScore']) AS m),
  (SELECT unnest({[*FEATURE_COLUMNS, 'Intercept']}) AS i)""")
def q_fit_gradients(spark, d):
    """Both fits are optimal: the gradient of their objective is 0 for each input."""
    out = None
    for label, fit in (("IsFraud", models.fit_classifier), ("RiskScore", models.fit_regressor)):
        train, _ = models.split_for_models(models.model_input(features(spark, d), label))
        g = models.gradients(fit(train), train).withColumn("model", F.lit(label))
        out = g if out is None else out.unionByName(g)
    return out


# ============================ bronze loads (B1) =================================

_BRONZE = {"customers": ("customer_raw", "c_raw2", "customer"), "accounts": ("account_raw", "a_raw", "account"),
           "transactions": ("transaction_raw", "t_raw", "transaction")}


def _bronze(name: str) -> None:
    table, block, kind = _BRONZE[name]
    schema, lineage = BRONZE_TABLES[table]
    columns = ", ".join(schema.fieldNames())
    extra = ", true AS HasLineage" if lineage else ""

    def load(spark, d):
        """Two file drops, two runs: each file is loaded once, with lineage for customers."""
        raw = {"customer": lambda: driver.customer_raw_batches(spark, d)[2], "account": lambda: driver.account_raw(spark, d),
               "transaction": lambda: driver.transaction_raw(spark, d)}[kind]().select(*schema.fieldNames())
        landing, root = work_path(spark, f"landing-{name}"), work_path(spark, f"bronze-{name}")
        late = F.pmod(F.xxhash64(*schema.fieldNames()), F.lit(2)) == 1
        out = None
        for drop, hit in (("1", ~late), ("2", late)):
            (raw.where(hit).write.option("header", True).option("ignoreLeadingWhiteSpace", False)
             .option("ignoreTrailingWhiteSpace", False).csv(f"{landing}/drop={drop}"))
            out = load_incremental(spark, landing, schema, f"{root}/table", f"{root}/checkpoint", recursive=True, lineage=lineage)
        flag = [(F.col("IngestionDate").isNotNull() & F.col("SourceFile").contains("drop=")).alias("HasLineage")] if lineage else []
        return out.select(*schema.fieldNames(), *flag)

    register(f"bronze_{name}", sql(f"SELECT {columns}{extra} FROM {block}", block))(load)


for _name in _BRONZE:
    _bronze(_name)


_LINE = "concat_ws(',', coalesce(AccountID, ''), CustomerID, AccountType, Currency, OpenDate)"
cte("account_lines", ("a_raw",), f"""
SELECT CAST(CustomerID AS BIGINT) % 23 AS kind, coalesce(AccountID, '') AS id, CustomerID, AccountType, Currency, OpenDate, {_LINE} AS line,
  CASE CAST(CustomerID AS BIGINT) % 23 WHEN 5 THEN concat_ws(',', coalesce(AccountID, ''), CustomerID, AccountType, Currency)
    WHEN 6 THEN {_LINE} || ',extra' WHEN 7 THEN concat_ws(',', coalesce(AccountID, ''), CustomerID, AccountType, Currency, '"' || OpenDate)
    WHEN 8 THEN concat_ws(',', coalesce(AccountID, ''), CustomerID, '"' || AccountType, Currency, OpenDate) END AS broken
FROM a_raw""")


@register("bronze_quarantine", sql("""
SELECT broken IS NOT NULL AS Quarantined, coalesce(broken, line) AS Line, broken IS NOT NULL AS HasFile, count(*) AS Rows
FROM account_lines GROUP BY 1, 2, 3""", "account_lines"))
def q_bronze_quarantine(spark, d):
    """Two drops of account files with lines of too few and too many fields and with unclosed
    quotes: whole lines are loaded, the others kept with their text and file."""
    columns = BRONZE_TABLES["account_raw"][0].fieldNames()
    raw = driver.account_raw(spark, d)
    kind = F.pmod(F.col("CustomerID").cast("long"), F.lit(23))
    field = {c: F.coalesce(F.col(c), F.lit("")) for c in columns}
    line = lambda **new: F.concat_ws(",", *[new.get(c, field[c]) for c in columns])
    quoted = lambda c, end="": F.concat(F.lit('"'), field[c], F.lit(end))
    text = (F.when(kind == 5, F.concat_ws(",", *[field[c] for c in columns[:-1]])).when(kind == 6, F.concat(line(), F.lit(",extra")))
            .when(kind == 7, line(OpenDate=quoted("OpenDate"))).when(kind == 8, line(AccountType=quoted("AccountType")))
            .when(kind == 9, line(AccountType=quoted("AccountType", '"'))).otherwise(line()))
    lines = raw.select(text.alias(",".join(columns)), (F.pmod(F.xxhash64(*columns), F.lit(2)) == 1).alias("late"))
    landing, root = work_path(spark, "landing-lines"), work_path(spark, "bronze-lines")
    for drop, hit in (("1", ~F.col("late")), ("2", F.col("late"))):
        (lines.where(hit).drop("late").write.option("header", True).option("sep", "\x01").option("quote", "").option("emptyValue", "")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{landing}/drop={drop}"))
        good = load_incremental(spark, landing, BRONZE_TABLES["account_raw"][0], f"{root}/table", f"{root}/checkpoint", recursive=True, quarantine=True)
    bad = quarantined(spark, f"{root}/table")
    out = good.select(F.lit(False).alias("Quarantined"), line().alias("Line"), F.lit(False).alias("HasFile"))
    out = out.unionByName(bad.select(F.lit(True).alias("Quarantined"), F.col("RawLine").alias("Line"), F.col("RawFile").contains("drop=").alias("HasFile")))
    return out.groupBy("Quarantined", "Line", "HasFile").agg(F.count("*").alias("Rows"))


# ============================ at-scale storage variants ========================


@register("fact_upsert_partitioned", sql(f"""
SELECT {FACT_OUT}, strftime(TransactionDate, '%Y-%m') AS TransactionMonth FROM moved_merged""", "moved_merged"))
def q_fact_upsert_partitioned(spark, d):
    """Two deliveries into a month-partitioned table: the second moves every
    transaction of 1996-03 to other dates (its month comes out empty) and
    restates those from 1997-07 on; only the touched months are rewritten."""
    from .layers import upsert_fact_partitioned
    s = S(spark, d)
    raw = driver.transaction_raw(spark, d, keep_true_date=True)
    true = F.col("_true_date")
    b1 = raw.where(true < F.lit("1998-01-01").cast("date")).drop("_true_date")
    first = silver.fact_source(b1, s.customer_dim, s.account_dim).select("TransactionID", "TransactionDate")
    march = first.where(F.date_format("TransactionDate", "yyyy-MM") == "1996-03").select("TransactionID").hint("merge")
    late = raw.where(true >= F.lit("1997-07-01").cast("date")).join(march, "TransactionID", "left_anti").drop("_true_date")
    moved = b1.join(march, "TransactionID", "left_semi").withColumn("TransactionDate", F.lit("04/01/1997"))
    b2 = late.unionByName(moved).withColumn("RiskScore", F.concat("RiskScore", F.lit("0")))
    path = work_path(spark, "fact-by-month")
    upsert_fact_partitioned(b1, s.customer_dim, s.account_dim, path)
    return upsert_fact_partitioned(b2, s.customer_dim, s.account_dim, path)


@register("scd2_merge_partitioned", sql("""
SELECT d.*, CASE WHEN d.IsCurrent THEN 'current' WHEN o.IsCurrent IS NOT NULL AND NOT o.IsCurrent THEN 'run_2' ELSE 'run_3' END AS VersionSet
FROM dim2 d LEFT JOIN dim1 o ON d.CustomerSK = o.CustomerSK""", "dim2", "dim1"))
def q_scd2_merge_partitioned(spark, d):
    """The customer dimension's three runs into a history table: current versions apart
    from those that each run closed, every run reading the loads after the one before.
    Run 3 first sees a part of its load only and is repeated with all of it."""
    from .layers import upsert_customer_dim_partitioned
    s = S(spark, d)
    path = work_path(spark, "customer-dim-versions")
    upsert_customer_dim_partitioned(s.customer_raw[0], path, "1")
    upsert_customer_dim_partitioned(s.customer_raw[1], path, "2", since=driver.BATCH0_INGESTED)
    part = s.customer_raw[2].where(F.length("CustomerID") < 3)
    upsert_customer_dim_partitioned(part, path, "3", since=driver.BATCH1_INGESTED)
    return upsert_customer_dim_partitioned(s.customer_raw[2], path, "3", since=driver.BATCH1_INGESTED)


def fresh_database(spark: SparkSession, name: str) -> str:
    """A new database whose tables lie in the shared work folder."""
    path = work_path(spark, name)
    db = "ledgerlake_" + re.sub(r"\W", "_", path.rsplit("/", 1)[-1])
    spark.sql(f"CREATE DATABASE `{db}` LOCATION '{path}'")
    return db


# ============================ bucketed tables (S13, S14, S16) ===================

#: Buckets of the registered queries' tables; at volume a bucket is a join task's share of the target.
BUCKETS = 16


@register("fact_upsert_bucketed", sql(f"SELECT {FACT_OUT} FROM fact_merged", "fact_merged"))
def q_fact_upsert_bucketed(spark, d):
    """The two deliveries of ``fact_upsert`` into a table bucketed by TransactionID: the second joins
    it without shuffling it."""
    s = S(spark, d)
    raw = driver.transaction_raw(spark, d, keep_true_date=True)
    b1 = raw.where(F.col("_true_date") < F.lit("1998-01-01").cast("date")).drop("_true_date")
    b2 = (raw.where(F.col("_true_date") >= F.lit("1997-07-01").cast("date")).drop("_true_date")
          .withColumn("RiskScore", F.concat("RiskScore", F.lit("0"))))
    name = f"{fresh_database(spark, 'bucketed')}.transaction_fact"
    for run, batch in (("1", b1), ("2", b2)):
        out = upsert_bucketed(silver.fact_source(batch, s.customer_dim, s.account_dim), name, run, "TransactionID", BUCKETS)
    return out


@register("scd1_merge_bucketed", sql("SELECT * FROM acct_merged", "acct_merged"))
def q_scd1_merge_bucketed(spark, d):
    """The two deliveries of ``scd1_merge`` into a table bucketed by AccountID."""
    s = S(spark, d)
    raw = driver.account_raw(spark, d)
    early = (driver.table(spark, d, "orders").where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
             .select(F.col("o_custkey").cast("string").alias("CustomerID")))
    name = f"{fresh_database(spark, 'bucketed')}.account_dim"
    for run, batch in (("1", raw.join(early.hint("merge"), "CustomerID", "left_semi")), ("2", raw.withColumn("AccountType", F.lower("AccountType")))):
        source = silver.dedup_accounts(silver.stage_accounts(batch, s.customer_dim))
        out = scd1_bucketed(source, silver.empty(spark, ACCOUNT_DIM), name, run, "AccountID", "AccountSK",
                            ["CustomerSK", "AccountType", "Currency", "OpenDate"], BUCKETS)
    return out


@register("scd2_merge_bucketed", sql("SELECT * FROM dim2", "dim2"))
def q_scd2_merge_bucketed(spark, d):
    """The customer dimension's three runs into a table bucketed by CustomerID, each reading one load."""
    s, name = S(spark, d), f"{fresh_database(spark, 'bucketed')}.customer_dim"
    for run, (raw, since) in enumerate(zip(s.customer_raw, (None, driver.BATCH0_INGESTED, driver.BATCH1_INGESTED))):
        source = silver.dedup_customers(silver.stage_customers(silver.newer_loads(raw, since)))
        out = scd2_bucketed(source, silver.empty(spark, CUSTOMER_DIM), name, str(run), "CustomerID", CUSTOMER_TRACKED, "CustomerSK", BUCKETS)
    return out


# ============================ incremental features and gold =====================

#: Months that the incremental queries change after the tables were built.
LATE_MONTHS = {"1996-03", "1997-11"}


def _late(fact: DataFrame) -> DataFrame:
    """The fact before a third of the transactions of two months came in."""
    late = F.col("TransactionMonth").isin(*LATE_MONTHS) & (F.pmod(F.xxhash64("TransactionID"), F.lit(3)) == 0)
    return fact.where(~F.coalesce(late, F.lit(False)))


def _stored_fact(spark: SparkSession, fact: DataFrame) -> tuple[DataFrame, str]:
    path = work_path(spark, "fact-months")
    fact.hint("rebalance", "TransactionMonth").write.partitionBy("TransactionMonth").parquet(path)
    return read_partitions(spark, path, "TransactionMonth"), path


@register("features_incremental", sql("SELECT * FROM features", "features"))
def q_features_incremental(spark, d):
    """The feature table after late facts in two months: only the months they reach are computed anew."""
    s, home = S(spark, d), driver.DRIVER_HOME_COUNTRY
    whole, path = by_month(s.fact), work_path(spark, "features-by-month")
    stored, at = _stored_fact(spark, _late(whole))
    incremental.build_features(stored, s.customer_dim, path, home)
    now = replace_partitions(whole.where(F.col("TransactionMonth").isin(*LATE_MONTHS)), at, "TransactionMonth", LATE_MONTHS)
    return rounded_ratio(incremental.refresh_features(now, s.customer_dim, LATE_MONTHS, path, home).drop("TransactionMonth"))


_GOLD_SQL = {"account_type_launderingrate": ("share_by_one_key", "AccountType", "NULL", "LaunderingRate"),
             "Uganda_Fraud": ("share_filtered", "Country", "CAST(IsFraud AS VARCHAR)", "RiskCategoryRate"),
             "luandering_channel": ("share_by_two_keys", "Channel", "KYCStatus", "LaunderingRate"),
             "Country_FraudVol": ("group_count", "Country", "CAST(IsFraud AS VARCHAR)", "FraudCount"),
             "riskscore_dow": ("avg_by_dow", "Name", "DayOfWeek", "AvgRiskScore"),
             "luandering_account": ("share_three_way", "AccountType", "KYCStatus", "LaunderingRate"),
             "Country_LaunderingRate": ("share_by_country", "Country", "NULL", "LaunderingRate")}


def _gold_view(view: str) -> str:
    """The oracle of a gold view as a block of its own, in the long form (View, G1, G2, Value)."""
    key, g1, g2, value = _GOLD_SQL[view]
    body = ORACLE[key]
    inner = body[body.rindex("\nSELECT ") + 1 :] if body.startswith("WITH") else body
    cte(f"gold_{key}", ("fact", "dim2", "acct"), inner)
    return f"SELECT '{view}' AS View, {g1} AS G1, {g2} AS G2, CAST({value} AS DOUBLE) AS Value FROM gold_{key}"


_GOLD_LONG = [_gold_view(v) for v in _GOLD_SQL]
_GOLD_LONG.append("SELECT 'daily', CAST(Date AS VARCHAR), NULL, CAST(FraudVolume AS DOUBLE) FROM daily")


@register("gold_incremental", sql(" UNION ALL ".join(_GOLD_LONG), *(f"gold_{k[0]}" for k in _GOLD_SQL.values()), "daily"))
def q_gold_incremental(spark, d):
    """All gold views and the daily volume from stored partials, after late, moved and deleted facts.

    The partials are built of a fact that lacks late rows of two months, holds a fifth of
    1995-05 forty days too early and rows of 1995-08 that were deleted since."""
    s = S(spark, d)
    whole, path = by_month(s.fact), work_path(spark, "gold-partials")
    month, chance = F.col("TransactionMonth"), F.pmod(F.xxhash64("TransactionID"), F.lit(5))
    early = (month == "1995-05") & (chance == 0)
    before = _late(whole).withColumn("TransactionDate", F.when(early, F.date_sub("TransactionDate", 40)).otherwise(F.col("TransactionDate")))
    before = by_month(before.unionByName(whole.where((month == "1995-08") & (chance == 1)).withColumn("TransactionID", F.concat(F.lit("gone "), "TransactionID"))))
    touched = LATE_MONTHS | {"1995-03", "1995-04", "1995-05", "1995-08"}
    stored, at = _stored_fact(spark, before)
    incremental.build_partials(stored, path)
    now = replace_partitions(whole.where(month.isin(*touched)), at, "TransactionMonth", touched)
    partials = incremental.refresh_partials(now, touched, path)
    views = incremental.gold_from_partials(partials, s.customer_dim, s.account_dim, driver.DRIVER_EXCLUDED_COUNTRY)
    out = incremental.daily_volume_from_partials(partials).select(
        F.lit("daily").alias("View"), F.col("Date").cast("string").alias("G1"), F.lit(None).cast("string").alias("G2"), F.col("FraudVolume").cast("double").alias("Value"))
    for name, v in views.items():
        g = [F.col(c).cast("string") for c in v.columns[:-1]]
        out = out.unionByName(v.select(F.lit(name).alias("View"), g[0].alias("G1"), (g[1] if len(g) > 1 else F.lit(None).cast("string")).alias("G2"),
                                       F.col(v.columns[-1]).cast("double").alias("Value")))
    return out


# ============================ stored tables and views (S7-S9, S11, O1) ==========


@register("alter_append", sql("""
SELECT CustomerID, CustomerName, CASE WHEN IngestionDate > TIMESTAMP '1998-01-01' THEN SourceFile END AS SourceFile FROM c_raw2""", "c_raw2"))
def q_alter_append(spark, d):
    """A stored table altered between two appends: rows stored before read NULL in the new column."""
    raw = driver.customer_raw_batches(spark, d)
    name, columns = f"{fresh_database(spark, 'altered')}.customer_raw", ["CustomerID", "CustomerName"]
    append_table(raw[1].select(*columns), name)
    alter_add_columns(spark, name, LINEAGE)
    newest = silver.newer_loads(raw[2], driver.BATCH1_INGESTED)
    return append_by_name(newest.select("SourceFile", *columns), name).select(*columns, "SourceFile")


@register("stored_views", sql(" UNION ALL ".join(
    f"SELECT '{v}' AS View, Position, G1, G2, Value FROM (SELECT *, row_number() OVER (ORDER BY Value DESC NULLS LAST, G1 NULLS FIRST, G2 NULLS FIRST) AS Position "
    f"FROM ({_gold_view(v)}))" for v in _GOLD_SQL), *(f"gold_{k[0]}" for k in _GOLD_SQL.values())))
def q_stored_views(spark, d):
    """The seven stored views over catalog tables, read by another session, with each row's place."""
    from .views import VIEW_SQL, create_gold_views
    s = S(spark, d)
    db = fresh_database(spark, "views")
    for name, df in (("customer_dim", s.customer_dim), ("account_dim", s.account_dim), ("transaction_fact", s.fact)):
        overwrite_table(df, f"{db}.{name}")
    create_gold_views(spark, db, driver.DRIVER_EXCLUDED_COUNTRY)
    out = None
    for name in VIEW_SQL:
        v = spark.table(f"{db}.{name}")
        g, value = v.columns[:-1], v.columns[-1]
        # groups are as many as the names: their places in the view's own order come without a window over all
        rows = in_row_order(v, "Position").select(F.lit(name).alias("View"), "Position", F.col(g[0]).cast("string").alias("G1"),
                        (F.col(g[1]).cast("string") if len(g) > 1 else F.lit(None).cast("string")).alias("G2"), F.col(value).cast("double").alias("Value"))
        out = rows if out is None else out.unionByName(rows)
    return out

# ============================ rejected rows ====================================


@register("rejects", sql(f"""
SELECT TableName, Rule, count(*) AS Rows FROM (
  SELECT 'customer' AS TableName, 'null_key' AS Rule FROM c_raw2 WHERE CustomerID IS NULL
  UNION ALL SELECT 'customer', 'invalid_date' FROM c_raw2 WHERE {parse('EffectiveDate', CUST_PATTERNS, trim=True)} IS NULL
  UNION ALL SELECT 'account', 'null_key' FROM a_raw WHERE AccountID IS NULL
  UNION ALL SELECT 'account', 'invalid_date' FROM a_raw WHERE {parse('OpenDate', ACCT_PATTERNS)} IS NULL
  UNION ALL SELECT 'transaction', 'null_key' FROM t_raw WHERE TransactionID IS NULL
  UNION ALL SELECT 'transaction', 'invalid_date' FROM t_raw WHERE {parse('TransactionDate', ACCT_PATTERNS)} IS NULL
  UNION ALL SELECT 'transaction', 'invalid_amount' FROM t_raw
    WHERE Amount IS NOT NULL AND try_cast(replace(Amount, ',', '') AS DECIMAL(10,2)) IS NULL)
GROUP BY TableName, Rule""", "c_raw2", "a_raw", "t_raw"))
def q_rejects(spark, d):
    """Raw rows that a silver run doesn't use in full, counted per rule."""
    s = S(spark, d)
    return reject_counts(run_rejects(s.customer_raw[2], s.account_raw, s.transaction_raw))
