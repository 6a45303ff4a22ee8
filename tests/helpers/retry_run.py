"""Run SCD2 and SCD1 merges twice: once clean, once with the first attempt of
some tasks failing inside the source plan.  Prints OK when both agree."""

import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerlake.operators.merge import scd1_merge, scd2_merge  # noqa: E402
from ledgerlake.session import ensure_checkpoint_dir  # noqa: E402

spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "6")
         .getOrCreate())
spark.sparkContext.setLogLevel("OFF")
ensure_checkpoint_dir(spark)


@F.udf("string")
def flaky(x):  # test-only fault injection: first attempt of even partitions fails
    tc = TaskContext.get()
    if tc.attemptNumber() == 0 and tc.partitionId() % 2 == 0:
        marks = os.environ.get("RETRY_MARKS")
        if marks:
            open(os.path.join(marks, f"s{tc.stageId()}-p{tc.partitionId()}"), "w").close()
        raise RuntimeError("injected task failure")
    return x


DIM = "SK long, ID string, A string, StartDate date, EndDate date, IsCurrent boolean"
target = spark.createDataFrame([(i + 1, f"k{i:04d}", "a", dt.date(2025, 1, 1), None, True) for i in range(500)], DIM)
src_rows = [(f"k{i:04d}", "a" if i % 3 else "b", dt.date(2025, 2, 1)) for i in range(250, 900)]
source = spark.createDataFrame(src_rows, "ID string, A string, EffectiveDate date").repartition(4)


def run(src):
    d2 = scd2_merge(target, src, "ID", ["A"], "SK")
    a = sorted(tuple(r) for r in d2.collect())
    s1 = scd1_merge(target.select("SK", "ID", "A"), src.select("ID", "A"), "ID", "SK", ["A"])
    b = sorted(tuple(r) for r in s1.collect())
    return a, b


clean = run(source)
faulty = run(source.withColumn("ID", flaky("ID")))
# 500 target versions (83 of them closed), 83 re-opened versions, 400 new keys
expected = 500 + 83 + 400
print("OK" if clean == faulty and len(clean[0]) == expected else
      f"DIFF equal={clean == faulty} rows={len(clean[0])}/{len(faulty[0])}")
