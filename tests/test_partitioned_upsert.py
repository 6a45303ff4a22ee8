"""Tables kept across runs: only touched partitions are rewritten, stopped runs can be repeated."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.merge import fact_upsert, scd2_merge
from ledgerlake.session import work_path
from ledgerlake.sources import tables
from ledgerlake.sources.tables import read_history, read_partitions, read_run, replace_partitions, run_before, upsert_history, upsert_partitions, write_run


def _files(df):
    """Files that the table's rows come from."""
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def _fact(spark, rows):
    return spark.createDataFrame(rows, "id string, d date, v int").withColumn("month", F.date_format("d", "yyyy-MM"))


def _upsert(spark, path, batch):
    return upsert_partitions(spark, path, batch, "id", "month")[0]


def test_upsert_rewrites_only_touched_partitions(spark):
    path = work_path(spark, "fact-partitioned")
    rows = [(f"t{i}", dt.date(2025, 1 + i % 3, 1 + i % 28), i) for i in range(90)]
    base = _fact(spark, rows)
    before = _files(_upsert(spark, path, base))
    # batch: updates and inserts in March, one row (t0, January) moves to March
    batch = _fact(spark, [("t2", dt.date(2025, 3, 5), 1000), ("t0", dt.date(2025, 3, 9), 2000),
                          ("new", dt.date(2025, 3, 1), 3000)])
    out, touched = upsert_partitions(spark, path, batch, "id", "month")
    assert touched == {"2025-01", "2025-03"}
    got = {r.id: (r.month, r.v) for r in out.collect()}
    assert len(got) == 91 and out.count() == 91
    assert got["t0"] == ("2025-03", 2000) and got["t2"] == ("2025-03", 1000) and got["new"] == ("2025-03", 3000)
    assert got == {r.id: (r.month, r.v) for r in fact_upsert(base, batch, "id").collect()}
    after = _files(out)
    feb = {f for f in before if "month=2025-02" in f}
    assert feb and feb <= after                                      # untouched partition kept as is
    jan = {f for f in before if "month=2025-01" in f}
    assert jan and not (jan & after)                                 # January rewritten (t0 left it)


def test_moved_key_leaves_an_emptied_partition(spark):
    path = work_path(spark, "fact-moved")
    _upsert(spark, path, _fact(spark, [("1", dt.date(2025, 1, 5), 1), ("2", dt.date(2025, 3, 5), 2)]))
    out = _upsert(spark, path, _fact(spark, [("1", dt.date(2025, 2, 5), 10)]))
    assert sorted((r.id, r.month, r.v) for r in out.collect()) == [("1", "2025-02", 10), ("2", "2025-03", 2)]
    out = _upsert(spark, path, _fact(spark, [("1", dt.date(2025, 1, 5), 11), ("2", dt.date(2025, 1, 5), 12)]))
    assert sorted((r.id, r.month, r.v) for r in out.collect()) == [("1", "2025-01", 11), ("2", "2025-01", 12)]
    assert read_partitions(spark, path, "month").count() == 2


def test_a_run_that_stops_between_partitions_is_mended_by_repeating_it(spark):
    path = work_path(spark, "fact-crash")
    _upsert(spark, path, _fact(spark, [("1", dt.date(2025, 1, 5), 1), ("2", dt.date(2025, 3, 5), 2), ("5", dt.date(2025, 1, 6), 5)]))
    batch = _fact(spark, [("1", dt.date(2025, 3, 5), 99), ("3", dt.date(2025, 2, 5), 3)])
    # the new March is there, the new January isn't: key 1 stands in both
    replace_partitions(_fact(spark, [("1", dt.date(2025, 3, 5), 99), ("2", dt.date(2025, 3, 5), 2)]), path, "month", {"2025-03"})
    for _ in range(2):
        out = _upsert(spark, path, batch)
        assert sorted((r.id, r.month, r.v) for r in out.collect()) == [
            ("1", "2025-03", 99), ("2", "2025-03", 2), ("3", "2025-02", 3), ("5", "2025-01", 5)]


def _run(spark, path, rows, run_id):
    dim = "SK long, CustomerID string, A string, StartDate date, EndDate date, IsCurrent boolean"
    source = spark.createDataFrame(rows, "CustomerID string, A string, EffectiveDate date")
    merge = lambda cur, start: scd2_merge(cur if cur is not None else spark.createDataFrame([], dim), source,
                                          "CustomerID", ["A"], "SK", key_start=start)
    return upsert_history(spark, path, run_id, merge, "SK")


def test_repeated_run_starts_from_the_table_before_it(spark):
    path = work_path(spark, "history")
    _run(spark, path, [("x", "1", dt.date(2025, 1, 1)), ("y", "1", dt.date(2025, 1, 1))], "1")
    _run(spark, path, [("x", "2", dt.date(2025, 2, 1))], "2")
    out = _run(spark, path, [("x", "2", dt.date(2025, 2, 1)), ("y", "2", dt.date(2025, 2, 1))], "2")
    got = sorted((r.CustomerID, r.A, r.IsCurrent, r.VersionSet) for r in out.collect())
    assert got == [("x", "1", False, "run_2"), ("x", "2", True, "current"), ("y", "1", False, "run_2"), ("y", "2", True, "current")]
    assert len({r.SK for r in out.collect()}) == 4
    _run(spark, path, [("x", "3", dt.date(2025, 3, 1))], "3")
    with pytest.raises(ValueError, match="not the latest run"):
        _run(spark, path, [("x", "9", dt.date(2025, 2, 1))], "2")


def test_a_run_that_stops_half_way_changes_nothing_for_readers(spark, monkeypatch):
    path = work_path(spark, "history-crash")
    _run(spark, path, [("x", "1", dt.date(2025, 1, 1))], "1")
    before = sorted(map(tuple, read_history(spark, path).collect()))
    write = tables.write_run

    def stop(df, where, run_id):
        if where.endswith("/current"):
            raise RuntimeError("lost")
        return write(df, where, run_id)

    with monkeypatch.context() as m:
        m.setattr(tables, "write_run", stop)
        with pytest.raises(RuntimeError, match="lost"):
            _run(spark, path, [("x", "2", dt.date(2025, 2, 1))], "2")
    assert sorted(map(tuple, read_history(spark, path).collect())) == before
    out = _run(spark, path, [("x", "2", dt.date(2025, 2, 1))], "2")
    assert sorted((r.A, r.IsCurrent, r.SK) for r in out.collect()) == [("1", False, 1), ("2", True, 2)]


def test_snapshots_per_run(spark):
    path = work_path(spark, "whole")
    assert read_run(spark, path) is None and run_before(spark, path, "1") is None
    write_run(spark.range(5).toDF("id"), path, "1")
    old = read_run(spark, path)
    write_run(old.where("id > 2"), path, "2")
    write_run(read_run(spark, path, "2").where("id > 3"), path, "2")  # repeated, from its own rows
    assert old.count() == 5 and sorted(r.id for r in read_run(spark, path).collect()) == [4]
    assert run_before(spark, path, "2") == "1" and run_before(spark, path, "3") == "2"


def test_null_partition_is_merged_not_dropped(spark):
    path = work_path(spark, "fact-null-part")
    base = spark.createDataFrame([("a", None, 1), ("b", "2025-01", 2), ("c", None, 3)], "id string, m string, v int")
    upsert_partitions(spark, path, base, "id", "m")
    batch = spark.createDataFrame([("c", None, 30), ("d", None, 4)], "id string, m string, v int")
    out, touched = upsert_partitions(spark, path, batch, "id", "m")
    assert touched == {None}
    assert sorted((r.id, r.m, r.v) for r in out.collect()) == [
        ("a", None, 1), ("b", "2025-01", 2), ("c", None, 30), ("d", None, 4)]
    with pytest.raises(ValueError, match="outside"):
        replace_partitions(batch, path, "m", {"2025-01"})
