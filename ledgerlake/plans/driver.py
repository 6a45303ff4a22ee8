"""Bronze-shaped inputs derived from the driver's TPC-H-style tables.

The driver tables hold no banking data, so each bronze table is a Spark
projection of them (SURVEY section 7.4):

* transactions <- ``orders`` (+ ``nation`` for the destination):
  o_orderkey -> TransactionID (one key in 40 repeats the key before it, one in
  211 is NULL), o_custkey -> CustomerID, o_custkey + 1000000 -> AccountID,
  o_orderdate -> TransactionDate text, o_totalprice -> Amount text,
  o_orderstatus -> TransactionType and IsFraud (F=1, O=0, P=NULL),
  o_orderpriority -> Channel and IsLaundered (URGENT/HIGH = 1), key % 100 -> RiskScore
* customer observations <- ``orders`` x ``customer`` x ``nation``: one raw
  customer row per order (RiskCategory = priority, KYCStatus = status,
  EffectiveDate = order date; one in 199 without CustomerID, two customers in
  50 share a name), loaded in three batches split at 1996-06-01 and 1998-01-01
* accounts <- ``customer``: c_custkey + 1000000 -> AccountID (one in 97 NULL),
  c_mktsegment -> AccountType; one account in 7 has a second row with another
  open date and type

Dirty text is produced from clean columns by fixed rules on the row key, so
the same rows and the same dirt appear at every scale factor and in the
DuckDB oracle (``ledgerlake.plans.oracle``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import silver

# Fixed values of the mapping (mirrored by the oracle SQL).
FIRST_SPLIT_DATE = "1996-06-01"
BATCH_SPLIT_DATE = "1998-01-01"
BATCH0_INGESTED = "1996-06-01 00:00:00"
BATCH1_INGESTED = "1998-01-01 00:00:00"
BATCH2_INGESTED = "2001-09-01 00:00:00"
ACCOUNT_OFFSET = 1_000_000
ORDERS_SOURCE = "driver/orders"
DRIVER_HOME_COUNTRY = "NATION_0"
DRIVER_EXCLUDED_COUNTRY = "Nation_1"
ACCOUNT_OPEN_BASE = "1990-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def date_text(key: Column, d: Column) -> Column:
    """Date as text in one of several layouts chosen by ``key % 20``.

    0-5 ``MM/dd/yyyy``, 6-9 ``dd/MM/yyyy``, 10-14 ``MMM dd yyyy``,
    15-17 ``yyyy-MM-dd``, 18 ``MM/dd/yyyy`` after a blank, 19 junk.
    """
    m = F.pmod(key, F.lit(20))
    return (F.when(m < 6, F.date_format(d, "MM/dd/yyyy"))
            .when(m < 10, F.date_format(d, "dd/MM/yyyy"))
            .when(m < 15, F.date_format(d, "MMM dd yyyy"))
            .when(m < 18, F.date_format(d, "yyyy-MM-dd"))
            .when(m == 18, F.concat(F.lit(" "), F.date_format(d, "MM/dd/yyyy")))
            .otherwise(F.lit("n/a")))


def amount_text(key: Column, price: Column) -> Column:
    """Price as text with two decimals; every third key with thousands
    separators, one key in fifty unparsable."""
    cents = F.round(price * 100).cast("long")
    whole, frac = F.floor(cents / 100).cast("long"), F.pmod(cents, F.lit(100))
    tail = F.concat(F.lit("."), F.lpad(frac.cast("string"), 2, "0"))
    m3 = F.pmod(key, F.lit(3))
    return (F.when(F.pmod(key, F.lit(50)) == 49, F.lit("N/A"))
            .when(m3 == 0, F.concat(F.format_number(whole, 0), tail))
            .otherwise(F.concat(whole.cast("string"), tail)))


def transaction_raw(spark: SparkSession, sf_dir: str, keep_true_date: bool = False) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(n, F.pmod(o.o_orderkey, F.lit(25)) == n.n_nationkey, "left")
    k = F.col("o_orderkey")
    dest = F.when(F.pmod(k, F.lit(10)) == 3, F.concat(F.col("n_name"), F.lit(" "))).otherwise(F.col("n_name"))
    return j.select(
        (F.when(F.pmod(k, F.lit(211)) == 7, F.lit(None)).when(F.pmod(k, F.lit(40)) == 1, k - 1).otherwise(k)
         .cast("string").alias("TransactionID")),
        F.col("o_custkey").cast("string").alias("CustomerID"),
        (F.col("o_custkey") + ACCOUNT_OFFSET).cast("string").alias("AccountID"),
        date_text(k, F.col("o_orderdate").cast("date")).alias("TransactionDate"),
        amount_text(k, F.col("o_totalprice")).alias("Amount"),
        F.col("o_orderstatus").alias("TransactionType"),
        F.col("o_orderpriority").alias("Channel"),
        dest.alias("DestinationCountry"),
        F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "0").alias("IsFraud"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "1").otherwise("0").alias("IsLaundered"),
        F.pmod(k, F.lit(100)).cast("string").alias("RiskScore"),
        *([F.col("o_orderdate").cast("date").alias("_true_date")] if keep_true_date else []),
    )


def customer_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-customer dirty text: '@' in some names, case and blanks in countries."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    ck = F.col("c_custkey")
    name = (F.when(F.pmod(ck, F.lit(50)).isin(10, 11), F.lit("Shared @Name"))
            .when(F.pmod(ck, F.lit(5)) == 0, F.regexp_replace("c_name", "#", "@#")).otherwise(F.col("c_name")))
    m3 = F.pmod(ck, F.lit(3))
    country = (F.when(m3 == 0, F.col("n_name"))
               .when(m3 == 1, F.concat(F.lower("n_name"), F.lit(" ")))
               .otherwise(F.concat(F.lit("  "), F.col("n_name"))))
    return cn.select("c_custkey", name.alias("CustomerName"), country.alias("Country"), "c_mktsegment")


def customer_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw customer row per order, with the order date as effective date."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                              "o_orderpriority", "o_orderstatus")
    a = customer_attrs(spark, sf_dir)
    j = o.join(a.hint("merge"), o.o_custkey == a.c_custkey, "inner")  # customers grow with the orders
    return j.select(
        (F.when(F.pmod("o_orderkey", F.lit(199)) != 4, F.col("o_custkey")).cast("string").alias("CustomerID")),
        "CustomerName", "Country",
        F.col("o_orderpriority").alias("RiskCategory"),
        F.col("o_orderstatus").alias("KYCStatus"),
        F.col("c_mktsegment").alias("Occupation"),
        date_text(F.col("o_orderkey"), F.col("o_orderdate").cast("date")).alias("EffectiveDate"),
        F.col("o_orderdate").cast("date").alias("_true_date"),
    )


def customer_raw_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The bronze customer table with lineage columns after each of three loads.

    Each load appends to the earlier ones, so a run's staging reads all batches
    so far, as the reference's appended bronze table does.
    """
    obs = customer_observations(spark, sf_dir)
    date = F.col("_true_date")
    first, second = F.lit(FIRST_SPLIT_DATE).cast("date"), F.lit(BATCH_SPLIT_DATE).cast("date")
    loads = [(date < first, BATCH0_INGESTED), ((date >= first) & (date < second), BATCH1_INGESTED),
             (date.isNull() | (date >= second), BATCH2_INGESTED)]
    out: list[DataFrame] = []
    for hit, ingested in loads:
        batch = (obs.where(hit).drop("_true_date").withColumn("IngestionDate", F.lit(ingested).cast("timestamp"))
                 .withColumn("SourceFile", F.lit(ORDERS_SOURCE)))
        out.append(out[-1].unionByName(batch) if out else batch)
    return out


def account_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    ck = F.col("c_custkey")
    m4 = F.pmod(ck, F.lit(4))
    # The currency spellings of the reference sample.
    currency = (F.when(m4 == 0, F.lit("UGX")).when(m4 == 1, F.lit("usd"))
                .when(m4 == 2, F.lit("UGX ")).otherwise(F.lit("USD")))
    opened = F.date_add(F.lit(ACCOUNT_OPEN_BASE).cast("date"), F.pmod(ck, F.lit(1500)).cast("int"))
    rows = c.withColumn("_copy", F.explode(F.when(F.pmod(ck, F.lit(7)) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    again = F.col("_copy") == 1
    return rows.select(
        F.when(F.pmod(ck, F.lit(97)) != 3, ck + ACCOUNT_OFFSET).cast("string").alias("AccountID"),
        ck.cast("string").alias("CustomerID"),
        F.when(again, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("AccountType"),
        currency.alias("Currency"),
        date_text(ck + F.col("_copy") * 3, F.date_add(opened, F.col("_copy") * 400)).alias("OpenDate"),
    )


class Silver:
    """The silver layer built from the driver tables, each table when it is first read: a
    query of the customers doesn't wait for the fact.

    With ``materialize=True`` every silver table is published as a parquet
    snapshot in the shared work folder as soon as it is built (the reference
    keeps them as tables too): later jobs start from a scan, lineage stays
    short and a lost executor recomputes from the last snapshot only.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = False):
        self.spark, self.sf_dir, self.materialize = spark, sf_dir, materialize

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        from ..sources.tables import publish

        return publish(df, name=name) if self.materialize else df

    @cached_property
    def customer_raw(self) -> list[DataFrame]:
        return customer_raw_batches(self.spark, self.sf_dir)

    @cached_property
    def customer_dim_0(self) -> DataFrame:
        return self._keep(silver.customer_job(None, self.customer_raw[0]), "customer_dim_0")

    @cached_property
    def customer_dim_1(self) -> DataFrame:
        return self._keep(silver.customer_job(self.customer_dim_0, self.customer_raw[1], since=BATCH0_INGESTED), "customer_dim_1")

    @cached_property
    def customer_dim(self) -> DataFrame:
        return self._keep(silver.customer_job(self.customer_dim_1, self.customer_raw[2], since=BATCH1_INGESTED), "customer_dim")

    @cached_property
    def account_raw(self) -> DataFrame:
        return account_raw(self.spark, self.sf_dir)

    @cached_property
    def account_dim(self) -> DataFrame:
        return self._keep(silver.account_job(None, self.account_raw, self.customer_dim), "account_dim")

    @cached_property
    def transaction_raw(self) -> DataFrame:
        return transaction_raw(self.spark, self.sf_dir)

    @cached_property
    def fact(self) -> DataFrame:
        return self._keep(silver.fact_job(None, self.transaction_raw, self.customer_dim, self.account_dim), "transaction_fact")


def folder_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Paths, sizes and modification times of the input files (a listing: no file is opened)."""
    paths = [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in ("orders", "customer", "nation")]
    files = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    return tuple(sorted(map(tuple, files.collect())))


_BUILT: dict[tuple[str, str], tuple[tuple, Silver]] = {}


def silver_tables(spark: SparkSession, sf_dir: str) -> Silver:
    """Materialized silver layer of an application and input folder.

    It is built anew whenever a file of the folder has changed, so no result
    depends on which query ran first.
    """
    key, state = (spark.sparkContext.applicationId, sf_dir.rstrip("/")), folder_state(spark, sf_dir)
    if key not in _BUILT or _BUILT[key][0] != state:
        _BUILT[key] = (state, Silver(spark, sf_dir, materialize=True))
    return _BUILT[key][1]
