"""Incremental features and gold over a month-partitioned fact."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.operators.features import transaction_features
from ledgerlake.plans import gold, incremental
from ledgerlake.plans.layers import by_month
from ledgerlake.plans.silver import customer_job, newer_loads
from ledgerlake.operators import models
from ledgerlake.schemas import ACCOUNT_DIM, CUSTOMER_DIM, TRANSACTION_FACT
from ledgerlake.session import work_path
from ledgerlake.sources.tables import read_partitions, replace_partitions, upsert_partitions

D = dt.date


def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def _fact_rows(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        day = None if i % 40 == 0 else D(2024, 12, 1) + dt.timedelta(days=rng.randrange(240))
        out.append((f"t{i}", rng.choice([1, 1, 1, 2, 3, None]), rng.choice([10, 11, None]), day, Decimal(rng.randrange(1, 9999)) / 100,
                    "T", rng.choice(["web", "atm", None]), rng.choice(["Uganda", "Kenya"]), rng.choice([True, False, None]), rng.choice([True, False, None]),
                    rng.choice([None, 5, 50, 95])))
    return out


def _dims(spark):
    customers = spark.createDataFrame([(k, f"C{k}", f"N{k % 2}", ["Uganda", "Kenya", "Togo"][k - 1], "low", ["ok", "no"][k % 2], "x", D(2024, 1, k), None, True)
                                       for k in (1, 2, 3)], CUSTOMER_DIM)
    accounts = spark.createDataFrame([(10, "A10", 1, "Savings", "UGX", D(2024, 1, 1)), (11, "A11", 3, "Mobile", "USD", D(2024, 1, 1))], ACCOUNT_DIM)
    return customers, accounts


def test_months_reached_and_needed():
    assert incremental.reached({"2025-01"}) == {"2025-01", "2025-02", "2025-03"}       # 31 January + 30 days is 2 March
    assert incremental.reached({"2024-01"}) == {"2024-01", "2024-02", "2024-03"}
    assert incremental.reached({"2024-12", None}) == {"2024-12", "2025-01", None}
    assert incremental.needed({"2025-03"}) == {"2025-01", "2025-02", "2025-03"}        # 1 March - 30 days is 30 January
    assert incremental.needed({"2025-05", None}) == {"2025-04", "2025-05", None}
    assert incremental.reached(set()) == set()


def _months_read(df):
    """Month folders of the files that the plan's scans would read."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan, {f.split("TransactionMonth=")[1].split("/")[0] for f in df.inputFiles() if "TransactionMonth=" in f}


def test_features_after_late_facts(spark):
    """Late facts in two months: the refreshed table equals the full build, other months are not read."""
    customers, _ = _dims(spark)
    rows = _fact_rows(600, 1)
    late = [r for i, r in enumerate(rows) if r[3] and r[3].strftime("%Y-%m") in ("2025-01", "2025-05") and i % 3 == 0]
    base = by_month(spark.createDataFrame([r for r in rows if r not in late], TRANSACTION_FACT))
    path, stored = work_path(spark, "fact"), work_path(spark, "features")
    upsert_partitions(spark, path, base, "TransactionID", "TransactionMonth")
    incremental.build_features(read_partitions(spark, path, "TransactionMonth"), customers, stored)
    before = set(read_partitions(spark, stored, "TransactionMonth").inputFiles())
    fact, touched = upsert_partitions(spark, path, by_month(spark.createDataFrame(late, TRANSACTION_FACT)), "TransactionID", "TransactionMonth")
    assert touched == {"2025-01", "2025-05"}
    got = incremental.refresh_features(fact, customers, touched, stored)
    want = transaction_features(spark.createDataFrame(rows, TRANSACTION_FACT), customers)
    assert _rows(got.drop("TransactionMonth")) == _rows(want)
    kept = {f for f in before if any(f"TransactionMonth={m}/" in f for m in ("2024-12", "2025-04", "2025-07", "__HIVE_DEFAULT_PARTITION__"))}
    assert kept and kept <= set(got.inputFiles())                                      # months that aren't reached keep their files
    one = incremental.feature_rows(fact, customers, incremental.reached({"2025-05"}))  # reads April to June
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [TransactionMonth" in plan and "2025-04" in plan and "2025-03" not in plan and "2025-07" not in plan


def test_gold_after_moved_late_and_deleted_facts(spark):
    customers, accounts = _dims(spark)
    rows = _fact_rows(500, 2)
    path, partials = work_path(spark, "fact"), work_path(spark, "partials")
    upsert_partitions(spark, path, by_month(spark.createDataFrame(rows, TRANSACTION_FACT)), "TransactionID", "TransactionMonth")
    incremental.build_partials(read_partitions(spark, path, "TransactionMonth"), partials)
    before = set(read_partitions(spark, partials, "TransactionMonth").inputFiles())
    # all of January moves to March, one row loses its date, new rows come in, February is deleted
    changed = [(*r[:3], D(2025, 3, 9), *r[4:]) for r in rows if r[3] and (r[3].year, r[3].month) == (2025, 1)]
    changed += [(*rows[1][:3], None, *rows[1][4:]), ("new", 2, 11, D(2025, 3, 1), Decimal("1.00"), "T", "web", "Kenya", True, True, 7)]
    fact, touched = upsert_partitions(spark, path, by_month(spark.createDataFrame(changed, TRANSACTION_FACT)), "TransactionID", "TransactionMonth")
    assert {"2025-01", "2025-03", None} <= touched
    fact = replace_partitions(fact.limit(0), path, "TransactionMonth", {"2025-02"})
    touched |= {"2025-02"}
    now = incremental.refresh_partials(fact, touched, partials)
    want, got = gold.build_gold(fact, customers, accounts), incremental.gold_from_partials(now, customers, accounts)
    assert set(got) == set(want) == set(gold.GOLD_VIEWS)
    for name in want:
        assert got[name].columns == want[name].columns and _rows(got[name]) == _rows(want[name]), name
    daily = models.daily_flag_volume(transaction_features(fact.drop("TransactionMonth"), customers))
    assert _rows(incremental.daily_volume_from_partials(now)) == _rows(daily)
    assert {f for f in before if "TransactionMonth=2025-06/" in f} <= set(now.inputFiles())
    # an overwritten account type needs no month again
    renamed = accounts.withColumn("AccountType", F.upper("AccountType"))
    assert _rows(incremental.gold_from_partials(now, customers, renamed)["luandering_account"]) == _rows(gold.laundering_by_account_kyc(fact, renamed, customers))


def test_staging_reads_new_loads_only(spark):
    """Run 3 equals a run that ranks all loads, and its scan is pruned to the folder of load 3."""
    rows = []
    for load, day in enumerate(("2025-01-01", "2025-02-01", "2025-03-01")):
        for c in range(6):
            if (c + load) % 4:
                rows.append((f"C{c}", f"name {c}", "uganda", f"risk{(c * load) % 3}", "ok", "x", "bad" if c == 5 and load == 2 else f"0{load + 1}/02/2025", f"{day} 10:00:00"))
    schema = "CustomerID string, CustomerName string, Country string, RiskCategory string, KYCStatus string, Occupation string, EffectiveDate string, IngestionDate string"
    path = work_path(spark, "bronze-loads")
    df = spark.createDataFrame(rows, schema).withColumn("IngestionDate", F.col("IngestionDate").cast("timestamp"))
    df.withColumn("LoadDate", F.to_date("IngestionDate")).write.partitionBy("LoadDate").parquet(path)
    raw = spark.read.parquet(path)
    marks = [None, "2025-01-01 10:00:00", "2025-02-01 10:00:00"]
    full = inc = None
    for load, since in enumerate(marks):
        seen = raw.where(F.col("IngestionDate") <= f"2025-0{load + 1}-01 10:00:00")
        full, inc = customer_job(full, seen), customer_job(inc, seen, since=since)
        assert _rows(inc) == _rows(full)
    plan = newer_loads(raw, marks[2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(LoadDate" in plan and "2025-02-01" in plan
