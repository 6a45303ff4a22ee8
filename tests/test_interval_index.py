"""As-of lookup through interval cells: the rows of the plain join, linear work."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerlake.operators.interval_index import asof_lookup_indexed, cut_plan, indexed_sides
from ledgerlake.operators.lookup import asof_lookup

DAY0 = dt.date(2000, 1, 1)


def _day(n):
    return DAY0 + dt.timedelta(days=n)


def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def _dim(spark, rows):
    return spark.createDataFrame(rows, "ID string, SK long, StartDate date, EndDate date")


def _chain(key, starts, sk=0):
    """Versions that follow each other: each ends on the day the next one starts, the last is open."""
    return [(key, sk + i, _day(s), _day(starts[i + 1]) if i + 1 < len(starts) else None) for i, s in enumerate(starts)]


def test_same_rows_as_the_plain_join(spark):
    rng = random.Random(1)
    rows = _chain("many", sorted(rng.sample(range(4000), 300)))
    rows += _chain("dense", [0, *range(3000, 3100)], 1000)                                  # one long version, a hundred in a season
    rows += _chain("few", [10, 500, 900], 2000) + _chain("old", [-9000 + 30 * i for i in range(40)], 3000)
    rows += [("loose", 4000 + i, _day(a := rng.randint(0, 3000)), _day(a + rng.randint(-5, 900))) for i in range(60)]  # overlapping, some reversed
    rows += [("many", 5000, None, _day(5)), (None, 5001, _day(0), None), ("many", 5002, _day(100), _day(100)), ("many", 5002, _day(100), _day(100))]
    facts = [(i, rng.choice(["many", "dense", "few", "old", "loose", "none", None]), _day(rng.randint(-9500, 4500))) for i in range(3000)]
    facts += [(9000, "many", None), (9001, "dense", _day(3050)), (9001, "dense", _day(3050)), (9002, "many", _day(10**5)), (9003, "old", _day(-10**5))]
    fact, dim = spark.createDataFrame(facts, "T long, ID string, d date"), _dim(spark, rows)
    want = _rows(asof_lookup(fact, dim, "ID", "d", ["SK"]))
    assert _rows(asof_lookup_indexed(fact, dim, "ID", "d", ["SK"])) == want
    assert _rows(asof_lookup_indexed(fact, dim, "ID", "d", ["SK"], light=0, salt=3)) == want
    assert _rows(asof_lookup_indexed(fact, dim, "ID", "d", ["SK"], light=10**6)) == want   # nothing is cut
    inner = _rows(asof_lookup(fact, dim, "ID", "d", ["SK"], how="inner"))
    assert _rows(asof_lookup_indexed(fact, dim, "ID", "d", ["SK"], how="inner")) == inner


def _pairs(fact, dim, light=16):
    """Candidate pairs of the join and index rows."""
    plan = cut_plan(dim, "ID", "StartDate", "EndDate", light)
    f, d = indexed_sides(fact, dim, plan, "ID", "d", ["SK"], "ID", "StartDate", "EndDate")
    return f.join(d, (f["ID"] == d["_ak"]) & (f["_cell"] == d["_dcell"])).count(), d.count()


def test_candidates_grow_with_the_facts(spark):
    """A customer with 1000 versions and 1e5 facts: 1e8 pairs in the plain join."""
    facts = spark.range(100_000).select(F.col("id").alias("T"), F.lit("hot").alias("ID"),
                                        F.date_add(F.lit(DAY0), F.pmod(F.xxhash64("id"), F.lit(5000)).cast("int")).alias("d"))
    for starts in ([5 * i for i in range(1000)], [0, *range(4000, 4999)], [i // 2 for i in range(1000)]):
        dim = _dim(spark, _chain("hot", starts))
        pairs, rows = _pairs(facts, dim)
        found = asof_lookup(facts, dim, "ID", "d", ["SK"], how="inner").count()
        assert pairs <= 4 * 100_000 + found, (pairs, found)
        assert rows <= 6 * len(starts)
    far = [(*r[:3], r[3] or dt.date(9999, 12, 31)) for r in _chain("hot", [5 * i for i in range(1000)])]
    assert _pairs(facts, _dim(spark, far))[1] <= 6000  # a far end makes no cells
    light = _dim(spark, _chain("hot", [0, 100, 200]))
    assert _pairs(facts, light) == (300_000, 3)  # few versions: the plain join


def test_plan_has_no_nested_loop(spark):
    dim = _dim(spark, _chain("many", [3 * i for i in range(100)]))
    fact = spark.createDataFrame([(1, "many", _day(4))], "T long, ID string, d date")
    plan = asof_lookup_indexed(fact, dim, "ID", "d", ["SK"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_tables(spark):
    fact, dim = spark.createDataFrame([], "T long, ID string, d date"), _dim(spark, [])
    assert asof_lookup_indexed(fact, dim, "ID", "d", ["SK"]).collect() == []
    one = spark.createDataFrame([(1, "a", _day(1))], "T long, ID string, d date")
    assert [tuple(r) for r in asof_lookup_indexed(one, dim, "ID", "d", ["SK"]).collect()] == [(1, "a", _day(1), None, None)]
