"""The layer sequence: bronze -> silver (customer, account, fact) -> gold -> features.

``run_silver`` is one scheduled run.  Passing the previous run's tables as
``previous`` continues history (SCD2 versions accumulate, surrogate keys are
kept); ``previous=None`` starts from empty tables, which is what the
reference's ``CREATE OR REPLACE TABLE`` before each merge amounts to.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import DEFAULT_HOME_COUNTRY, transaction_features
from ..operators.merge import scd2_merge
from ..schemas import CUSTOMER_DIM, CUSTOMER_TRACKED
from ..sources.tables import publish, read_partitions, read_run, run_before, upsert_history, upsert_partitions, write_run
from . import gold, silver
from .rejects import run_rejects


@dataclass
class SilverLayer:
    customer_dim: DataFrame
    account_dim: DataFrame
    fact: DataFrame
    rejects: DataFrame | None = None  # the rows this run did not use in full, by rule


def run_silver(customer_raw: DataFrame, account_raw: DataFrame, transaction_raw: DataFrame,
               previous: SilverLayer | None = None, materialize: bool = True) -> SilverLayer:
    """Customer job, then account job (needs current customer versions), then
    the fact job (needs both).  With ``materialize`` each table is published as
    a snapshot before the next job reads it."""
    keep = (lambda df, n: publish(df, name=n)) if materialize else (lambda df, n: df)
    prev = previous or SilverLayer(None, None, None)
    cust = keep(silver.customer_job(prev.customer_dim, customer_raw), "customer_dim")
    acct = keep(silver.account_job(prev.account_dim, account_raw, cust), "account_dim")
    fact = keep(silver.fact_job(prev.fact, transaction_raw, cust, acct), "transaction_fact")
    return SilverLayer(cust, acct, fact, keep(run_rejects(customer_raw, account_raw, transaction_raw), "rejects"))


def by_month(fact: DataFrame) -> DataFrame:
    """The fact with ``TransactionMonth`` (``yyyy-MM``; NULL dates form their own partition)."""
    return fact.withColumn("TransactionMonth", F.date_format("TransactionDate", "yyyy-MM"))


def upsert_fact_by_month(raw: DataFrame, customer_dim: DataFrame, account_dim: DataFrame, path: str) -> tuple[DataFrame, set[str | None]]:
    """Fact job against a month-partitioned table at ``path``: only the months the
    batch touches (plus months its keys move out of) are rewritten.  Returns the
    table and those months, which the incremental gold and feature tables take."""
    src = silver.fact_source(raw, customer_dim, account_dim)
    src = by_month(src.where(F.col("TransactionID").isNotNull()))
    return upsert_partitions(raw.sparkSession, path, src, "TransactionID", "TransactionMonth")


def upsert_fact_partitioned(raw: DataFrame, customer_dim: DataFrame, account_dim: DataFrame, path: str) -> DataFrame:
    return upsert_fact_by_month(raw, customer_dim, account_dim, path)[0]


def upsert_customer_dim_partitioned(raw: DataFrame, path: str, run_id: str, since=None, **merge_flags) -> DataFrame:
    """Customer job against a history table at ``path``: each run rewrites the current
    versions only and adds the versions it closed as a new partition."""
    src = silver.dedup_customers(silver.stage_customers(silver.newer_loads(raw, since)))

    def merge(current, key_start):
        tgt = current if current is not None else silver.empty(raw.sparkSession, CUSTOMER_DIM)
        return scd2_merge(tgt.select(*CUSTOMER_DIM.fieldNames()), src, "CustomerID", CUSTOMER_TRACKED,
                          "CustomerSK", key_start=key_start, **merge_flags)

    return upsert_history(raw.sparkSession, path, run_id, merge, "CustomerSK")


def run_silver_partitioned(customer_raw: DataFrame, account_raw: DataFrame, transaction_raw: DataFrame,
                           root: str, run_id: str, quarantine: DataFrame | None = None) -> SilverLayer:
    """One scheduled run against tables kept under ``root`` (a shared path); ``run_id`` sorts
    after the earlier runs' (a date).

    The customer dimension keeps its history apart (closed versions are never
    rewritten) and reads only the loads after the high-water mark of the run before;
    the fact is month-partitioned (only touched months are rewritten); the account
    dimension (one row per account, no history) is one snapshot per run.  A
    run that stops is repeated from the tables before it.  The rows the run
    rejected are stored under ``rejects``, one snapshot per run.
    """
    spark = customer_raw.sparkSession
    root, run_id = root.rstrip("/"), str(run_id)
    write_run(run_rejects(customer_raw, account_raw, transaction_raw, quarantine), f"{root}/rejects", run_id)
    rejects = read_partitions(spark, f"{root}/rejects", "run").withColumnRenamed("run", "RunID")
    before = run_before(spark, f"{root}/account_dim", run_id)
    since = read_mark(spark, f"{root}/customer_mark", before)
    cust = upsert_customer_dim_partitioned(customer_raw, f"{root}/customer_dim", run_id, since).drop("VersionSet")
    write_mark(customer_raw, "IngestionDate", since, f"{root}/customer_mark", run_id)
    prev_acct = read_run(spark, f"{root}/account_dim", before) if before is not None else None
    acct = write_run(silver.account_job(prev_acct, account_raw, cust), f"{root}/account_dim", run_id)
    fact = upsert_fact_partitioned(transaction_raw, cust, acct, f"{root}/transaction_fact").drop("TransactionMonth")
    return SilverLayer(cust, acct, fact, rejects)


def read_mark(spark, path: str, run_id: str | None):
    """The newest load time that a run has read; None before the first run."""
    found = read_run(spark, path, run_id) if run_id is not None else None
    return found.first()[0] if found is not None else None


def write_mark(raw: DataFrame, load_col: str, since, path: str, run_id: str) -> None:
    """Store the newest load time of ``raw`` as the mark of a run (that of the run before, if nothing is newer)."""
    newest = silver.newer_loads(raw, since).agg(F.max(load_col).alias("mark"))
    write_run(newest.select(F.coalesce("mark", F.lit(since).cast("timestamp")).alias("mark")), path, run_id)


def run_gold(layer: SilverLayer) -> dict[str, DataFrame]:
    return gold.build_gold(layer.fact, layer.customer_dim, layer.account_dim)


def run_features(layer: SilverLayer, home: str = DEFAULT_HOME_COUNTRY) -> DataFrame:
    return transaction_features(layer.fact, layer.customer_dim, home=home)
