"""Catalog helpers: create-if-absent, reset, append, overwrite, model outputs (S3, S4, S7, S8, M17)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.plans.model_jobs import forecast_job, publish_run
from ledgerlake.schemas import ACCOUNT_RAW
from ledgerlake.sources.tables import (append_table, create_if_absent, overwrite_table, publish,
                                       replace_empty)


def test_table_lifecycle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze_t")
    t = create_if_absent(spark, "bronze_t.account_raw", ACCOUNT_RAW)
    assert t.count() == 0 and t.columns == list(ACCOUNT_RAW.fieldNames())
    rows = spark.createDataFrame([("A1", "C1", "Savings", "UGX", "01/01/2024")], ACCOUNT_RAW)
    append_table(rows, "bronze_t.account_raw")
    append_table(rows, "bronze_t.account_raw")
    assert spark.table("bronze_t.account_raw").count() == 2
    create_if_absent(spark, "bronze_t.account_raw", ACCOUNT_RAW)          # existing table is kept
    assert spark.table("bronze_t.account_raw").count() == 2
    replace_empty(spark, "bronze_t.account_raw", ACCOUNT_RAW)             # the reset
    assert spark.table("bronze_t.account_raw").count() == 0
    overwrite_table(rows, "bronze_t.account_raw")
    overwrite_table(rows, "bronze_t.account_raw")
    assert spark.table("bronze_t.account_raw").count() == 1


def test_publish_view_and_model_outputs(spark):
    df = spark.range(5).withColumnRenamed("id", "x")
    out = publish(df, name="five", view="five_view")
    assert out.count() == 5 and spark.sql("SELECT sum(x) AS s FROM five_view").first().s == 10
    f = spark.createDataFrame([(dt.date(2025, 1, 1 + i % 9), i % 2 == 0) for i in range(40)],
                              "TransactionDate date, IsFraud boolean")
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_t")
    for _ in range(2):
        publish_run(forecast_job(f), "gold_t.fraud_forecast", "gold_t.model_metrics")
    assert spark.table("gold_t.fraud_forecast").count() == 9                 # overwritten
    m = spark.table("gold_t.model_metrics")
    assert m.count() == 6 and m.where(F.col("metric") == "r2").count() == 2  # appended per run


def test_stored_table_is_altered_and_appended_by_name(spark):
    import pytest
    from pyspark.sql import types as T

    from ledgerlake.sources.tables import alter_add_columns, append_by_name

    spark.sql("CREATE DATABASE IF NOT EXISTS alter_t")
    spark.createDataFrame([(1, "a")], "id int, v string").write.mode("overwrite").saveAsTable("alter_t.t")
    files = set(spark.table("alter_t.t").inputFiles())
    lineage = T.StructType([T.StructField("V", T.StringType()), T.StructField("loaded", T.TimestampType()), T.StructField("src", T.StringType())])
    assert alter_add_columns(spark, "alter_t.t", lineage).columns == ["id", "v", "loaded", "src"]
    assert alter_add_columns(spark, "alter_t.t", lineage).columns == ["id", "v", "loaded", "src"]       # nothing left to add
    assert files <= set(spark.table("alter_t.t").inputFiles())                                          # no file was rewritten
    append_by_name(spark.createDataFrame([("f", 2)], "src string, ID int"), "alter_t.t")
    other = spark.newSession().table("alter_t.t")
    assert sorted((r.id, r.v, r.loaded, r.src) for r in other.collect()) == [(1, "a", None, None), (2, None, None, "f")]
    with pytest.raises(ValueError, match="no columns"):
        append_by_name(spark.createDataFrame([(1, 2)], "id int, other int"), "alter_t.t")


def test_stored_views_survive_a_session_and_follow_their_tables(spark):
    from ledgerlake.plans.views import create_gold_views
    from ledgerlake.schemas import ACCOUNT_DIM, CUSTOMER_DIM, TRANSACTION_FACT

    spark.sql("CREATE DATABASE IF NOT EXISTS views_t")
    d = dt.date(2025, 1, 6)
    overwrite_table(spark.createDataFrame([(1, "C1", "Ann", "Togo", "x", "ok", "x", d, None, True)], CUSTOMER_DIM), "views_t.customer_dim")
    overwrite_table(spark.createDataFrame([(1, "A1", 1, "Savings", "UGX", d), (2, "A2", 1, "Mobile", "UGX", d)], ACCOUNT_DIM), "views_t.account_dim")
    fact = lambda *accounts: spark.createDataFrame(
        [(str(i), 1, a, d, None, "x", "web", "Togo", True, True, 10) for i, a in enumerate(accounts)], TRANSACTION_FACT)
    overwrite_table(fact(1, 1, 1, 2), "views_t.transaction_fact")
    spark.range(1).write.mode("overwrite").saveAsTable("views_t.riskscore_dow")   # a table of an earlier release
    assert len(create_gold_views(spark, "views_t")) == 7
    other = spark.newSession()
    assert [tuple(r) for r in other.table("views_t.account_type_launderingrate").collect()] == [("Savings", 75.0), ("Mobile", 25.0)]
    overwrite_table(fact(2, 2, 2, 1), "views_t.transaction_fact")
    create_gold_views(spark, "views_t")                                           # again: replaced
    assert [tuple(r) for r in spark.newSession().table("views_t.account_type_launderingrate").collect()] == [("Mobile", 75.0), ("Savings", 25.0)]
    assert [tuple(r) for r in spark.newSession().table("views_t.riskscore_dow").collect()] == [("Ann", "Mon", 10.0)]
