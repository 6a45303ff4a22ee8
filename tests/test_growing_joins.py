"""Joins whose two sides grow with the input are merged: no side is collected by the driver
because its parquet files are small.  The rows are written to files, as Spark's size check reads those."""

import datetime as dt

import pytest

from ledgerlake.operators import keys, lookup, merge
from ledgerlake.operators.features import transaction_features
from ledgerlake.operators.interval_index import asof_lookup_indexed
from ledgerlake.plans import driver, gold
from ledgerlake.schemas import ACCOUNT_DIM, CUSTOMER_DIM, TRANSACTION_FACT
from ledgerlake.sources.tables import overwrite_table

DAY = dt.date(2025, 1, 6)


@pytest.fixture(scope="module")
def layer(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layer"))
    rows = {"customer": ([(1, "C1", "Ann", "Togo", "x", "ok", "x", DAY, None, True), (2, "C2", "Bo", "Mali", "x", None, "x", DAY, None, True)], CUSTOMER_DIM),
            "account": ([(1, "A1", 1, "Savings", "UGX", DAY), (2, "A2", 2, "Mobile", "UGX", DAY)], ACCOUNT_DIM),
            "fact": ([(str(i), 1 + i % 2, 1 + i % 2, DAY, None, "x", "web", "Togo", True, True, 10) for i in range(5)], TRANSACTION_FACT)}
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in rows}


def _merged(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_lookups_are_merged(layer):
    from pyspark.sql import functions as F
    fact = layer["fact"].select("TransactionID", F.concat(F.lit("C"), "CustomerSK").alias("CustomerID"), "TransactionDate")
    for salt in (1, 3):
        found = (lookup.current_lookup(fact, layer["customer"], "CustomerID", ["KYCStatus"], salt=salt),
                 lookup.asof_lookup(fact, layer["customer"], "CustomerID", "TransactionDate", ["KYCStatus"], salt=salt),
                 lookup.left_lookup(fact, layer["customer"], "CustomerID", ["KYCStatus"], salt=salt),
                 asof_lookup_indexed(fact, layer["customer"], "CustomerID", "TransactionDate", ["KYCStatus"], salt=salt))
        for df in found:
            assert _merged(df)
            assert sorted((r.TransactionID, r.KYCStatus) for r in df.collect()) == [(str(i), None if i % 2 else "ok") for i in range(5)]


def test_merges_are_merged(layer):
    source = layer["customer"].withColumnRenamed("StartDate", "EffectiveDate")
    assert _merged(merge.scd2_close(layer["customer"], source, "CustomerID", ["Country"]))
    assert _merged(merge.scd2_new_versions(layer["customer"], source, "CustomerID", ["Country"]))
    plan = merge.scd1_merge(layer["account"], layer["account"], "AccountID", "AccountSK", ["AccountType"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 1  # the offsets of the new keys, one row per partition


def test_gold_views_and_features_are_merged(layer):
    for name, view in gold.build_gold(layer["fact"], layer["customer"], layer["account"]).items():
        assert _merged(view), name
    assert _merged(transaction_features(layer["fact"], layer["customer"]))
    assert _merged(transaction_features(layer["fact"], layer["customer"], method="window"))


def test_stored_views_are_merged(spark, layer):
    from ledgerlake.plans.views import create_gold_views
    spark.sql("CREATE DATABASE IF NOT EXISTS growing_t")
    for name, df in (("customer_dim", layer["customer"]), ("account_dim", layer["account"]), ("transaction_fact", layer["fact"])):
        overwrite_table(df, f"growing_t.{name}")
    for name in create_gold_views(spark, "growing_t"):
        assert _merged(spark.table(name)), name
    assert [tuple(r) for r in spark.table("growing_t.luandering_channel").collect()] == [("web", "ok", 60.0), ("web", None, 40.0)]


def test_row_order_numbers(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("(id * 37) % 1000 AS id").orderBy("id")
    out = keys.in_row_order(df, "n")
    assert "Window" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.n, r.id) for r in out.collect()) == [(i + 1, i) for i in range(1000)]
    assert keys.in_row_order(df.where("id < 0"), "n").collect() == []


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    spark.range(40).selectExpr("id AS o_orderkey", "id % 9 AS o_custkey", "'F' AS o_orderstatus", "1.5D AS o_totalprice",
                               "CAST(date_add(DATE'1996-01-01', CAST(id * 30 AS INT)) AS TIMESTAMP_NTZ) AS o_orderdate", "'1-URGENT' AS o_orderpriority").write.parquet(f"{root}/orders.parquet")
    spark.range(9).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name", "CAST(id % 2 AS INT) AS c_nationkey", "'AUTO' AS c_mktsegment").write.parquet(f"{root}/customer.parquet")
    spark.range(2).selectExpr("CAST(id AS INT) AS n_nationkey", "concat('NATION_', id) AS n_name", "1 AS n_regionkey").write.parquet(f"{root}/nation.parquet")
    return root


def test_customer_observations_are_merged(spark, folder):
    plan = driver.customer_observations(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan


def test_a_query_builds_the_silver_tables_it_reads(spark, folder):
    from ledgerlake.plans.registry import QUERIES
    tables = ("customer_dim_0", "customer_dim_1", "customer_dim", "account_dim", "fact")
    built = lambda: [t for t in tables if t in vars(driver.silver_tables(spark, folder))]
    assert QUERIES["dedup_valid"](spark, folder).count() > 0
    assert built() == []
    QUERIES["asof_lookup"](spark, folder)
    assert built() == ["customer_dim_0", "customer_dim_1", "customer_dim"]
    assert driver.silver_tables(spark, folder).fact.count() > 0
    assert built() == list(tables)
