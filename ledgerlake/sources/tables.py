"""Writing and reading tables: snapshot publish, create-if-absent, append.

Parquet files are immutable, so a table update is published as a new
snapshot folder and readers are repointed to it (a table cannot be
overwritten while the same job still reads it).  Written snapshots also cut
lineage: downstream plans start from a scan, not from the merge that built
them, and a lost executor only recomputes from the last snapshot.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import materialize, work_path


def publish(df: DataFrame, path: str | None = None, name: str = "table",
            partition_by: list[str] | None = None, view: str | None = None) -> DataFrame:
    """Write ``df`` as a fresh parquet snapshot and return a scan of it.

    ``path`` defaults to a new folder under the shared work folder
    (``spark.checkpoint.dir``); ``view`` registers the snapshot under a name.
    """
    spark = df.sparkSession
    target = path or work_path(spark, name)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    out = spark.read.parquet(target)
    if view:
        out.createOrReplaceTempView(view)
    return out


def overwrite_table(df: DataFrame, name: str) -> None:
    """``write.mode("overwrite").saveAsTable`` (model outputs)."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Append rows to a named table (bronze loads)."""
    df.write.mode("append").format("parquet").saveAsTable(name)


def create_if_absent(spark: SparkSession, name: str, schema, location: str | None = None) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS name (schema) USING parquet [LOCATION]``."""
    if not spark.catalog.tableExists(name):
        kw = {"path": location} if location else {}
        spark.catalog.createTable(name, source="parquet", schema=schema, **kw)
    return spark.table(name)


def alter_add_columns(spark: SparkSession, name: str, fields: StructType) -> DataFrame:
    """``ALTER TABLE name ADD COLUMNS``: those of ``fields`` that the stored table lacks (by name, whatever the case).

    No file is rewritten: rows stored before read NULL in the new columns, later
    appends fill them.
    """
    have = {c.lower() for c in spark.table(name).columns}
    missing = [f for f in fields.fields if f.name.lower() not in have]
    if missing:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in missing)})")
    return spark.table(name)


def append_by_name(df: DataFrame, name: str) -> DataFrame:
    """Append rows to a stored table by column name; columns that the table has and ``df`` lacks are NULL.
    Columns that the table lacks raise (``alter_add_columns`` adds them first)."""
    table = df.sparkSession.table(name)
    have, known = {c.lower(): c for c in df.columns}, {c.lower() for c in table.columns}
    if extra := [c for c in df.columns if c.lower() not in known]:
        raise ValueError(f"{name} has no columns {extra}")
    rows = df.select(*[(F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema.fields])
    rows.write.insertInto(name)
    return df.sparkSession.table(name)


def replace_empty(spark: SparkSession, name: str, schema) -> DataFrame:
    """``CREATE OR REPLACE TABLE`` of an empty typed table (the reference's reset)."""
    spark.createDataFrame([], schema).write.mode("overwrite").format("parquet").saveAsTable(name)
    return spark.table(name)


# ---- tables kept across runs ----------------------------------------------------
#
# Plain partitioned parquet folders.  A month-like table is changed by overwriting the
# partitions a batch touches; a table that is rebuilt as a whole keeps one snapshot per
# run (``run=<id>``), of which readers take the latest.


def read_partitions(spark: SparkSession, path: str, part_col: str) -> DataFrame | None:
    """The table at ``path``; partition values are text, whatever their folder names look
    like.  None when there is no table."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    fields = [StructField(f.name, StringType()) if f.name == part_col else f for f in found.schema.fields]
    return spark.read.schema(StructType(fields)).parquet(path)


def among(part_col: str, values: Sequence[str | None]) -> Column:
    """Whether the partition is one of ``values`` (NULL included); prunes the scan's partitions."""
    known = [v for v in values if v is not None]
    hit = F.col(part_col).isin(known) if known else F.lit(False)
    return hit | F.col(part_col).isNull() if None in values else hit  # isin never matches NULL


def distinct_values(df: DataFrame, col: str) -> set[str | None]:
    """The partition values of ``df`` (months, runs: as many as the table has folders)."""
    return {r[0] for r in df.select(col).distinct().collect()}


def replace_partitions(df: DataFrame, path: str, part_col: str, parts: Sequence[str | None]) -> DataFrame:
    """Overwrite the partitions ``parts`` of the table at ``path`` with ``df``; returns the table.

    ``df`` may be computed from the same table: it is written to the work folder
    first.  Its partitions replace the old ones; of ``parts``, those it has no row
    for come out empty.  Other partitions are neither read nor written.
    """
    spark = df.sparkSession
    staged = materialize(df.withColumn(part_col, F.col(part_col).cast("string")), "partitions")
    held = distinct_values(staged, part_col)
    if extra := held - set(parts):
        raise ValueError(f"rows for partitions outside the replaced ones: {sorted(map(str, extra))}")
    (_by_partition(staged, part_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part_col).parquet(path))
    known = read_partitions(spark, path, part_col)
    folders = partition_folders(known, part_col) if known is not None else set()
    for part in (set(parts) - held) & folders:
        folder = "__HIVE_DEFAULT_PARTITION__" if part is None else quote(part, safe=" -_.,")
        staged.drop(part_col).limit(0).write.mode("overwrite").parquet(f"{path}/{part_col}={folder}")
    return read_partitions(spark, path, part_col) or staged


def partition_folders(table: DataFrame, part_col: str) -> set[str | None]:
    """Partition values by the names of the table's files (a listing, no row is read)."""
    names = {m[1] for f in table.inputFiles() if (m := re.search(f"/{re.escape(part_col)}=([^/]*)/", f))}
    return {None if n == "__HIVE_DEFAULT_PARTITION__" else unquote(unquote(n)) for n in names}


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, key: str, part_col: str) -> tuple[DataFrame, set[str | None]]:
    """Upsert ``source`` by ``key`` into the table at ``path`` partitioned by ``part_col``;
    returns the table and the partitions that were rewritten.

    Touched are the batch's own values of ``part_col`` and the partitions that now
    hold a key of the batch (a row that moves must leave its old partition, which may
    come out empty).  Finding the latter reads only the key column.  A touched
    partition's new rows are its rows whose key the batch doesn't have, and the
    batch's; so a run that stopped between two partitions is mended by repeating it.
    """
    source = materialize(source.withColumn(part_col, F.col(part_col).cast("string")), "source")
    own = distinct_values(source, part_col)
    target = read_partitions(spark, path, part_col)
    if target is None:
        return replace_partitions(source, path, part_col, own), own
    keys = source.select(key).hint("merge")  # a batch's size on disk says little of its keys' size in memory
    touched = own | distinct_values(target.select(key, part_col).join(keys, key, "left_semi"), part_col)
    kept = target.where(among(part_col, touched)).join(keys, key, "left_anti")
    return replace_partitions(kept.select(*source.columns).unionByName(source), path, part_col, touched), touched


def runs(spark: SparkSession, path: str) -> list[str]:
    """Ids of the runs that have a snapshot at ``path``, in text order."""
    table = read_partitions(spark, path, "run")
    return sorted(r for r in partition_folders(table, "run") if r is not None) if table is not None else []


def read_run(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame | None:
    """A run's snapshot, by default the latest one's; None when there is none."""
    known = runs(spark, path)
    if not known:
        return None
    return read_partitions(spark, path, "run").where(F.col("run") == (run_id or known[-1])).drop("run")


def run_before(spark: SparkSession, path: str, run_id: str) -> str | None:
    """The run that ``run_id`` starts from.  The latest run may be repeated, an older one is refused."""
    known = runs(spark, path)
    if known and run_id < known[-1]:
        raise ValueError(f"run {run_id!r} is not the latest run of {path}")
    before = [r for r in known if r < run_id]
    return before[-1] if before else None


def write_run(df: DataFrame, path: str, run_id: str) -> DataFrame:
    """Publish ``df`` as the snapshot of a run (again, if the run is repeated): one folder,
    complete with its last step.  Earlier snapshots stay readable."""
    staged = materialize(df, "run")  # it may be computed from the snapshot it replaces
    staged.hint("rebalance").write.mode("overwrite").parquet(f"{path}/run={quote(run_id, safe=' -_.,')}")
    return read_run(df.sparkSession, path, run_id)


def _by_partition(df: DataFrame, part_col: str) -> DataFrame:
    """Group rows by table partition before a partitioned write (few files per
    partition); adaptive execution splits a partition that is too large and
    merges small ones, so a hot partition value is not written by one task."""
    return df.hint("rebalance", part_col)


def upsert_history(spark: SparkSession, path: str, run_id: str, merge, sk_col: str, current_col: str = "IsCurrent") -> DataFrame:
    """One run of a history-keeping table: ``current`` holds a snapshot of the current versions
    per run, ``closed`` the versions that each run closed.

    ``merge(current_versions or None, key_start)`` is the SCD2 merge; it reads the current
    versions before the run only, and closed ones are never read again (but their key
    column, for the largest key) nor rewritten.  The closed versions are written before
    the current ones, so a run that stops in between is mended by repeating it, and
    a repeated run starts from the tables before it.  Returns all versions with
    ``VersionSet``: ``current`` or the ``run_<id>`` that closed them.
    """
    before = run_before(spark, f"{path}/current", run_id)
    current = read_run(spark, f"{path}/current", before) if before is not None else None
    start = F.lit(0)
    if current is not None:
        largest = current.agg(F.max(sk_col)).first()[0] or 0
        closed = _closed(spark, path, before)
        if closed is not None:
            largest = max(largest, closed.agg(F.max(sk_col)).first()[0] or 0)
        start = F.lit(largest)
    merged = materialize(merge(current, start), "history")
    is_current = F.coalesce(F.col(current_col), F.lit(False))
    write_run(merged.where(~is_current), f"{path}/closed", run_id)
    write_run(merged.where(is_current), f"{path}/current", run_id)
    return read_history(spark, path)


def _closed(spark: SparkSession, path: str, last: str) -> DataFrame | None:
    table = read_partitions(spark, f"{path}/closed", "run")
    return table.where(F.col("run") <= last) if table is not None else None


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions after the latest complete run."""
    last = runs(spark, f"{path}/current")[-1]
    now = read_run(spark, f"{path}/current", last).withColumn("VersionSet", F.lit("current"))
    return now.unionByName(_closed(spark, path, last).withColumn("VersionSet", F.concat(F.lit("run_"), "run")).drop("run"))
