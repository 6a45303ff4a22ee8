"""Merges into bucketed tables: the rows of the plain merges, no shuffle of the target."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.merge import fact_upsert, scd1_merge, scd2_merge
from ledgerlake.sources import buckets

DIM1 = "SK long, ID string, A string"
DIM2 = "SK long, ID string, A string, StartDate date, EndDate date, IsCurrent boolean"


@pytest.fixture(scope="module")
def db(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucket_t")
    return "bucket_t"


def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def _batch(spark, run):
    day = dt.date(2025, run, 1)
    return spark.createDataFrame([(f"k{i}", f"a{(i * run) % 5}", day) for i in range(run * 3, 200 + run * 20)] + [(None, "x", day)],
                                 "ID string, A string, EffectiveDate date")


def _exchanged(df):
    """Relations below a shuffle of the executed plan: the stored table must not be among them."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines, out = plan.splitlines(), []
    for n, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            depth = len(re.match(r"[^A-Za-z(*]*", line)[0])
            for below in lines[n + 1 :]:
                if len(re.match(r"[^A-Za-z(*]*", below)[0]) <= depth:
                    break
                if "Scan" in below:
                    out.append(below)
    return plan, out


def test_upserts_equal_the_plain_merge(spark, db):
    name, plain = f"{db}.fact", None
    for run in (1, 2, 3):
        batch = _batch(spark, run)
        known = batch.where("ID is not null")
        plain = known if plain is None else fact_upsert(plain, known, "ID")
        out = buckets.upsert_bucketed(batch, name, f"run_{run}", "ID", 8)
        assert _rows(out) == _rows(plain)
    assert buckets.run_tables(spark, name) == ["run_1", "run_2", "run_3"]
    again = buckets.upsert_bucketed(_batch(spark, 3), name, "run_3", "ID", 8)       # a repeated run starts before itself
    assert _rows(again) == _rows(plain)
    with pytest.raises(ValueError, match="not the latest"):
        buckets.upsert_bucketed(_batch(spark, 2), name, "run_2", "ID", 8)
    assert buckets.drop_old_runs(spark, name, keep=1) == ["run_1", "run_2"]
    assert _rows(spark.newSession().table(name)) == _rows(plain)


def test_target_is_not_shuffled(spark, db):
    name = f"{db}.plan_fact"
    buckets.upsert_bucketed(_batch(spark, 1), name, "a", "ID", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = buckets.base_of(spark, name, "b")
        source = spark.read.parquet(*base.inputFiles()).withColumn("A", F.lit("new"))
        plan, shuffled = _exchanged(fact_upsert(base, source.hint("merge"), "ID"))
        assert "Bucketed: true" in plan and "SortMergeJoin" in plan
        assert len(shuffled) == 1 and "SelectedBucketsCount" not in shuffled[0]       # the batch alone
        files = spark.table(buckets._stored(name, "a")).inputFiles()
        assert len(files) <= 8                                                      # a file per bucket
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dimensions_equal_the_plain_merges(spark, db):
    empty1, empty2 = spark.createDataFrame([], DIM1), spark.createDataFrame([], DIM2)
    one, two = empty1, empty2
    for run in (1, 2, 3):
        batch = _batch(spark, run)
        one, two = scd1_merge(one, batch, "ID", "SK", ["A"]), scd2_merge(two, batch, "ID", ["A"], "SK")
        got1 = buckets.scd1_bucketed(batch, empty1, f"{db}.dim1", str(run), "ID", "SK", ["A"], 4)
        got2 = buckets.scd2_bucketed(batch, empty2, f"{db}.dim2", str(run), "ID", ["A"], "SK", 4)
        assert _rows(got1) == _rows(one) and _rows(got2) == _rows(two)


def test_run_ids_are_plain_names(spark, db):
    with pytest.raises(ValueError, match="run ids"):
        buckets.upsert_bucketed(_batch(spark, 1), f"{db}.odd", "2025-01-01", "ID", 4)
