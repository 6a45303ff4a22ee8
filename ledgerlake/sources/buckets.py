"""Bucketed catalog tables for merges that don't shuffle their target.

A table is stored by ``bucketBy`` / ``sortBy`` on its business key.  A merge joins the
scan to the batch; the scan's rows already lie in the join's partitions, so only the
batch is shuffled.  The merged rows leave the join bucket by bucket and are written
as they are.  Every run writes a catalog table of its own, ``<name>__<run>``, and then points
the view ``<name>`` at it: readers see the old table or the new one.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import fact_upsert, scd1_merge, scd2_merge

SEPARATOR = "__"


def _split(name: str) -> tuple[str, str]:
    database, _, table = name.rpartition(".")
    return database or "default", table


def run_tables(spark: SparkSession, name: str) -> list[str]:
    """Runs that stored a table for ``name``, in text order."""
    database, table = _split(name)
    found = spark.sql(f"SHOW TABLES IN `{database}`").collect()  # one row per table of the database
    prefix = f"{table}{SEPARATOR}".lower()
    return sorted(r.tableName[len(prefix):] for r in found if r.tableName.lower().startswith(prefix))


def _stored(name: str, run_id: str) -> str:
    if not re.fullmatch(r"\w+", run_id):
        raise ValueError(f"run ids are letters, digits and underscores, not {run_id!r}")
    database, table = _split(name)
    return f"`{database}`.`{table}{SEPARATOR}{run_id.lower()}`"


def base_of(spark: SparkSession, name: str, run_id: str) -> DataFrame | None:
    """The table that a run starts from: that of the latest run before it.  A later run's table refuses the run."""
    known = run_tables(spark, name)
    if any(r > run_id.lower() for r in known):
        raise ValueError(f"run {run_id!r} is not the latest run of {name}")
    before = [r for r in known if r < run_id.lower()]
    return spark.table(_stored(name, before[-1])) if before else None


def write_bucketed(df: DataFrame, name: str, run_id: str, key: str, buckets: int, shuffle: bool) -> DataFrame:
    """Store ``df`` as the table of a run and point ``name`` at it.

    ``shuffle`` brings the rows of a bucket together first; a merge with a bucketed
    table needs none, its rows come bucket by bucket.  A repeated run replaces its table.
    """
    spark = df.sparkSession
    database, table = _split(name)
    stored, view = _stored(name, run_id), f"`{database}`.`{table}`"
    before = [r for r in run_tables(spark, name) if r < run_id.lower()]
    if run_id.lower() in run_tables(spark, name):  # repeated: readers go back to the run before meanwhile
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {_stored(name, before[-1])}" if before else f"DROP VIEW IF EXISTS {view}")
        spark.sql(f"DROP TABLE {stored}")
    rows = df.repartition(buckets, key) if shuffle else df
    rows.write.bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(stored)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {stored}")
    return spark.table(name)


def drop_old_runs(spark: SparkSession, name: str, keep: int = 2) -> list[str]:
    """Drop the tables of all but the latest ``keep`` runs; returns the dropped runs."""
    old = run_tables(spark, name)[: -max(keep, 1)]
    for run_id in old:
        spark.sql(f"DROP TABLE {_stored(name, run_id)}")
    return old


def upsert_bucketed(source: DataFrame, name: str, run_id: str, key: str, buckets: int) -> DataFrame:
    """``fact_upsert`` into the bucketed table ``name``; the first run stores the batch."""
    base = base_of(source.sparkSession, name, run_id)
    known = source.where(F.col(key).isNotNull())
    if base is None:
        return write_bucketed(known, name, run_id, key, buckets, shuffle=True)
    return write_bucketed(fact_upsert(base, known.hint("merge"), key), name, run_id, key, buckets, shuffle=False)


def scd1_bucketed(source: DataFrame, empty: DataFrame, name: str, run_id: str, key: str, sk_col: str, update_cols, buckets: int) -> DataFrame:
    """``scd1_merge`` into the bucketed table ``name``; ``empty`` is its schema before the first run."""
    base = base_of(source.sparkSession, name, run_id)
    merged = scd1_merge(base if base is not None else empty, source, key, sk_col, update_cols)
    return write_bucketed(merged, name, run_id, key, buckets, shuffle=base is None)


def scd2_bucketed(source: DataFrame, empty: DataFrame, name: str, run_id: str, key: str, tracked, sk_col: str, buckets: int, **flags) -> DataFrame:
    """``scd2_merge`` into the bucketed table ``name`` (closed versions included)."""
    base = base_of(source.sparkSession, name, run_id)
    merged = scd2_merge(base if base is not None else empty, source, key, tracked, sk_col, **flags)
    return write_bucketed(merged, name, run_id, key, buckets, shuffle=base is None)
