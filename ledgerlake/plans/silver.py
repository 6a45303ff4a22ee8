"""Silver jobs: customer (SCD2), account (SCD1), transaction fact (upsert).

Each job is ``stage -> dedup -> merge``; every step returns a lazy DataFrame and
nothing runs until the caller publishes the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import (ACCOUNT_DATE_PATTERNS, CUSTOMER_DATE_PATTERNS,
                               INVALID_EFFECTIVE_DATE, INVALID_OPEN_DATE,
                               TRANSACTION_DATE_PATTERNS, VALID_EFFECTIVE_DATE,
                               VALID_OPEN_DATE, clean_name, parse_amount, parse_date,
                               quality_label, title_only, title_trimmed, to_flag, to_int)
from ..operators.dedup import latest_per_key
from ..operators.interval_index import asof_lookup_indexed
from ..operators.lookup import asof_lookup, current_lookup, left_lookup
from ..operators.merge import fact_upsert, scd1_merge, scd2_merge
from ..schemas import (ACCOUNT_DIM, CUSTOMER_DIM, CUSTOMER_TRACKED, FACT_COLUMNS,
                       TRANSACTION_FACT)


def empty(spark: SparkSession, schema) -> DataFrame:
    """An empty typed table, built on the JVM side (no Python workers).

    ``WHERE false`` makes Catalyst replace it by an empty local relation and
    drop the merge joins against it on a first run.  (Plain NULL literals
    would instead be folded into the join key and turn the equi join into a
    nested-loop join.)
    """
    one = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return one.where(F.lit(False))


# ---- customer (SCD2) -------------------------------------------------------
def stage_customers(raw: DataFrame, patterns=CUSTOMER_DATE_PATTERNS, trim_dates: bool = True) -> DataFrame:
    eff = parse_date("EffectiveDate", patterns, trim=trim_dates)
    staged = raw.select(
        "CustomerID",
        clean_name("CustomerName").alias("CustomerName"),
        title_trimmed("Country").alias("Country"),
        "RiskCategory", "KYCStatus", "Occupation",
        eff.alias("EffectiveDate"),
        "IngestionDate",
    )
    return staged.withColumn("QualityCheck", quality_label(
        "EffectiveDate", VALID_EFFECTIVE_DATE, INVALID_EFFECTIVE_DATE))


def dedup_customers(staged: DataFrame, filter_before_rank: bool = False) -> DataFrame:
    """Newest load first; inside one load the latest effective date (ties in
    the reference are arbitrary, here they are broken by every column)."""
    return latest_per_key(staged, ["CustomerID"], ["IngestionDate", "EffectiveDate"],
                          valid=F.col("QualityCheck") == VALID_EFFECTIVE_DATE,
                          filter_before_rank=filter_before_rank)


def newer_loads(raw: DataFrame, since=None) -> DataFrame:
    """The rows loaded after ``since`` (a load time); all rows without it.

    A table partitioned by ``LoadDate`` (the day of ``IngestionDate``) is read with
    pruning: folders of earlier days are not listed into the scan.
    """
    if since is None:
        return raw
    newer = raw.where(F.col("IngestionDate") > F.lit(since).cast("timestamp"))
    return newer.where(F.col("LoadDate") >= F.lit(since).cast("date")) if "LoadDate" in raw.columns else newer


def customer_job(target: DataFrame | None, raw: DataFrame, since=None, **merge_flags) -> DataFrame:
    """SCD2 run over ``raw``.  With the load time that the run before had read up to as
    ``since``, only newer loads are staged and ranked: the newest load of a key
    decides it, and a key without a newer row would be merged with the row that
    its current version came from, which changes nothing."""
    spark = raw.sparkSession
    tgt = target if target is not None else empty(spark, CUSTOMER_DIM)
    src = dedup_customers(stage_customers(newer_loads(raw, since)))
    return scd2_merge(tgt, src, "CustomerID", CUSTOMER_TRACKED, "CustomerSK", **merge_flags)


# ---- account (SCD1) --------------------------------------------------------
def stage_accounts(raw: DataFrame, customer_dim: DataFrame, patterns=ACCOUNT_DATE_PATTERNS,
                   trim_dates: bool = False) -> DataFrame:
    j = current_lookup(raw, customer_dim, "CustomerID", ["CustomerSK"])
    opened = parse_date("OpenDate", patterns, trim=trim_dates)
    staged = j.select("AccountID", "CustomerSK", "AccountType",
                      title_only("Currency").alias("Currency"), opened.alias("OpenDate"))
    return staged.withColumn("QualityCheck", quality_label("OpenDate", VALID_OPEN_DATE, INVALID_OPEN_DATE))


def dedup_accounts(staged: DataFrame, filter_before_rank: bool = False) -> DataFrame:
    return latest_per_key(staged, ["AccountID"], ["OpenDate"],
                          valid=F.col("QualityCheck") == VALID_OPEN_DATE,
                          filter_before_rank=filter_before_rank)


def account_job(target: DataFrame | None, raw: DataFrame, customer_dim: DataFrame) -> DataFrame:
    spark = raw.sparkSession
    tgt = target if target is not None else empty(spark, ACCOUNT_DIM)
    src = dedup_accounts(stage_accounts(raw, customer_dim))
    return scd1_merge(tgt, src, "AccountID", "AccountSK",
                      ["CustomerSK", "AccountType", "Currency", "OpenDate"])


# ---- transaction fact ------------------------------------------------------
def parse_transactions(raw: DataFrame, patterns=TRANSACTION_DATE_PATTERNS) -> DataFrame:
    """The CTE that types date and amount before any join."""
    return raw.select(
        "TransactionID", "CustomerID", "AccountID",
        parse_date("TransactionDate", patterns).alias("TransactionDate"),
        parse_amount("Amount").alias("Amount"),
        "TransactionType", "Channel", "DestinationCountry",
        "IsFraud", "IsLaundered", "RiskScore",
    )


def stage_transactions(raw: DataFrame, customer_dim: DataFrame, account_dim: DataFrame,
                       salt: int = 1, indexed: bool = False) -> DataFrame:
    """Customer version as of the transaction date, account by id (both left).
    ``salt > 1`` splits hot customers / accounts without relying on adaptive
    skew handling (see ``operators.lookup``); ``indexed`` cuts the intervals of
    customers with many versions into cells (see ``operators.interval_index``)."""
    parsed = parse_transactions(raw)
    asof = asof_lookup_indexed if indexed else asof_lookup
    j = asof(parsed, customer_dim, "CustomerID", "TransactionDate", ["CustomerSK"], salt=salt)
    return left_lookup(j, account_dim, "AccountID", ["AccountSK"], salt=salt)


def dedup_transactions(staged: DataFrame) -> DataFrame:
    """One row per TransactionID; on the change date (two versions match) the
    later version wins."""
    return latest_per_key(staged, ["TransactionID"], ["TransactionDate", "_asof_start"])


def typed_fact(deduped: DataFrame) -> DataFrame:
    """Text flags and score cast explicitly before the write."""
    out = (deduped.withColumn("IsFraud", to_flag("IsFraud"))
           .withColumn("IsLaundered", to_flag("IsLaundered"))
           .withColumn("RiskScore", to_int("RiskScore")))
    return out.select(*FACT_COLUMNS)


#: Tasks over which the jobs deal the facts of one customer or account in the lookups.
FACT_SALT = 4


def fact_source(raw: DataFrame, customer_dim: DataFrame, account_dim: DataFrame,
                salt: int = FACT_SALT) -> DataFrame:
    """The merge source: parsed, looked up, one row per transaction, typed."""
    return typed_fact(dedup_transactions(stage_transactions(raw, customer_dim, account_dim, salt, indexed=True)))


def fact_job(target: DataFrame | None, raw: DataFrame, customer_dim: DataFrame,
             account_dim: DataFrame, salt: int = FACT_SALT) -> DataFrame:
    spark = raw.sparkSession
    tgt = target if target is not None else empty(spark, TRANSACTION_FACT)
    return fact_upsert(tgt, fact_source(raw, customer_dim, account_dim, salt), "TransactionID")
