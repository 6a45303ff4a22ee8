"""Rows that a silver run doesn't use in full, with the rule that says why.

Nothing leaves a run unseen: rows without a key are kept out of the merges (they
can match nothing), rows whose newest date is invalid lose their key's update, and
texts that no number or date can be read from become NULL.  All of them are
returned here, stored with the run and counted per rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import (ACCOUNT_DATE_PATTERNS, CUSTOMER_DATE_PATTERNS, TRANSACTION_DATE_PATTERNS,
                               parse_amount, parse_date)


def _rules(table: str) -> dict[str, Column]:
    """Rule -> condition on a raw row."""
    if table == "customer":
        return {"null_key": F.col("CustomerID").isNull(),
                "invalid_date": parse_date("EffectiveDate", CUSTOMER_DATE_PATTERNS, trim=True).isNull()}
    if table == "account":
        return {"null_key": F.col("AccountID").isNull(),
                "invalid_date": parse_date("OpenDate", ACCOUNT_DATE_PATTERNS).isNull()}
    return {"null_key": F.col("TransactionID").isNull(),
            "invalid_date": parse_date("TransactionDate", TRANSACTION_DATE_PATTERNS).isNull(),
            "invalid_amount": F.col("Amount").isNotNull() & parse_amount("Amount").isNull()}


def rejected(table: str, raw: DataFrame) -> DataFrame:
    """(TableName, Rule, Row): a row per broken rule; ``Row`` is the raw row as JSON."""
    rules = _rules(table)
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(rule)) for rule, c in rules.items()]))
    return (raw.select(F.explode(broken).alias("Rule"), F.to_json(F.struct(*raw.columns)).alias("Row"))
            .select(F.lit(table).alias("TableName"), "Rule", "Row"))


def run_rejects(customer_raw: DataFrame, account_raw: DataFrame, transaction_raw: DataFrame,
                quarantine: DataFrame | None = None) -> DataFrame:
    """The rejected rows of one run over the three raw tables, and the malformed lines
    that the bronze load kept apart (``quarantine``: TableName, RawFile, RawLine)."""
    parts = [rejected("customer", customer_raw), rejected("account", account_raw), rejected("transaction", transaction_raw)]
    if quarantine is not None:
        parts.append(quarantine.select("TableName", F.lit("malformed_line").alias("Rule"), F.to_json(F.struct("RawFile", "RawLine")).alias("Row")))
    return reduce(DataFrame.unionByName, parts)


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rows per table and rule."""
    return rejects.groupBy("TableName", "Rule").agg(F.count("*").alias("Rows"))
