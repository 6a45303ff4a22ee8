"""Upserts on immutable files: each merge is a pure function (target, source) -> new target.

Row-level MERGE does not exist for plain parquet tables, so a merge here is a
DataFrame plan that the caller publishes as a new snapshot
(:func:`ledgerlake.sources.tables.publish`).  Every join is an equi join on the
business key with at most one row per key on each side, so nothing fans out and
no key is hot; both sides grow with the input, so they are merged, never broadcast.  ``scd2_close`` and ``scd2_new_versions`` are the two halves of
the SCD2 merge (the reference's MERGE and INSERT statements).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .keys import assign_keys, max_key


def null_key_rows(source: DataFrame, key: str) -> DataFrame:
    """Source rows whose key is NULL (they can never match a target row)."""
    return source.where(F.col(key).isNull())


def _without_null_keys(source: DataFrame, key: str, quarantine: bool) -> DataFrame:
    return source.where(F.col(key).isNotNull()) if quarantine else source


def _once(source: DataFrame, freeze: bool) -> DataFrame:
    """Write the batch once to the shared work folder: both halves of a merge read
    the same rows and the source plan doesn't run twice.  The target, which may be
    far larger, is never copied."""
    return materialize(source, "merge-source") if freeze else source


def fact_upsert(target: DataFrame, source: DataFrame, key: str,
                quarantine_null_keys: bool = True) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE all columns / WHEN NOT MATCHED INSERT.

    One full outer equi join on the key: a source row replaces its target row,
    unmatched rows of either side pass through.  Keys are unique on both sides,
    so the join cannot fan out and no key can be hot.
    """
    src = _without_null_keys(source, key, quarantine_null_keys).select(*target.columns)
    t = target.alias("t")
    s = src.withColumn("_in_s", F.lit(True)).alias("s")
    j = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full")
    hit = F.col("s._in_s").isNotNull()  # presence marker: NULL keys are rows too
    return j.select(*[F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns])


def scd1_merge(target: DataFrame, source: DataFrame, key: str, sk_col: str,
               update_cols: Sequence[str], quarantine_null_keys: bool = True,
               num_partitions: int | None = None, freeze: bool = True) -> DataFrame:
    """Overwrite-in-place dimension: matched rows keep their surrogate key and
    take the source values; new keys get ``max(sk)+1 ...`` in key order.

    Plan: the batch is written once; the target meets it in a left join, the
    batch meets the target's keys in an anti join, and only the new rows are
    written again by :func:`assign_keys`.
    """
    src = _once(_without_null_keys(source, key, quarantine_null_keys).select(key, *update_cols), freeze)
    t = target.alias("t")
    s = src.withColumn("_in_s", F.lit(True)).alias("s").hint("merge")
    hit = F.col("s._in_s").isNotNull()
    kept = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "left").select(*[
        F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in update_cols else F.col(f"t.{c}").alias(c)
        for c in target.columns])
    new = src.join(target.select(F.col(key).alias("_known")).hint("merge"), F.col(key) == F.col("_known"), "left_anti")
    new = new.select(*[F.col(c) if c in src.columns else F.lit(None).cast(target.schema[c].dataType).alias(c)
                       for c in target.columns if c != sk_col])
    fresh = assign_keys(new, [key], sk_col, start=max_key(target, sk_col), num_partitions=num_partitions)
    return kept.unionByName(fresh.select(*target.columns))


def _changed(tracked: Sequence[str], null_safe: bool) -> Column:
    if null_safe:
        diffs = [~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in tracked]
    else:  # plain <>: a change to or from NULL is not a change
        diffs = [F.col(f"t.{c}") != F.col(f"s.{c}") for c in tracked]
    return F.coalesce(reduce(lambda a, b: a | b, diffs), F.lit(False))


def scd2_close(target: DataFrame, source: DataFrame, key: str, tracked: Sequence[str],
               effective_col: str = "EffectiveDate", start_col: str = "StartDate",
               end_col: str = "EndDate", current_col: str = "IsCurrent",
               null_safe: bool = False, require_newer: bool = False) -> DataFrame:
    """MERGE ... WHEN MATCHED AND (changed) UPDATE SET EndDate, IsCurrent=false.

    Returns the whole target; changed current versions are closed with the
    source's effective date as their end date.
    """
    is_cur = F.coalesce(F.col(current_col), F.lit(False))
    t = target.where(is_cur).alias("t")
    s = source.select(key, *tracked, effective_col).withColumn("_in_s", F.lit(True)).alias("s").hint("merge")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "left")
    changed = F.col("s._in_s").isNotNull() & _changed(tracked, null_safe)
    if require_newer:
        changed = changed & F.coalesce(F.col(f"s.{effective_col}") > F.col(f"t.{start_col}"), F.lit(False))
    out = []
    for c in target.columns:
        if c == end_col:
            out.append(F.when(changed, F.col(f"s.{effective_col}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif c == current_col:
            out.append(F.when(changed, F.lit(False)).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return target.where(~is_cur).unionByName(joined.select(*out))  # closed history passes through


def scd2_new_versions(target: DataFrame, source: DataFrame, key: str, tracked: Sequence[str],
                      effective_col: str = "EffectiveDate", start_col: str = "StartDate",
                      current_col: str = "IsCurrent", null_safe: bool = False,
                      require_newer: bool = False) -> DataFrame:
    """INSERT ... SELECT of source keys with no current version or a change."""
    cur = target.where(F.col(current_col)).select(key, *tracked, start_col).alias("t").hint("merge")
    s = source.alias("s")
    joined = s.join(cur, F.col(f"s.{key}") == F.col(f"t.{key}"), "left")
    changed = _changed(tracked, null_safe)
    if require_newer:
        changed = changed & F.coalesce(F.col(f"s.{effective_col}") > F.col(f"t.{start_col}"), F.lit(False))
    keep = F.col(f"t.{key}").isNull() | changed
    return joined.where(keep).select(F.col(f"s.{key}").alias(key),
                                     *[F.col(f"s.{c}").alias(c) for c in tracked],
                                     F.col(f"s.{effective_col}").alias(start_col))


def scd2_merge(target: DataFrame, source: DataFrame, key: str, tracked: Sequence[str],
               sk_col: str, effective_col: str = "EffectiveDate", start_col: str = "StartDate",
               end_col: str = "EndDate", current_col: str = "IsCurrent",
               null_safe: bool = False, require_newer: bool = False,
               quarantine_null_keys: bool = True, num_partitions: int | None = None,
               freeze: bool = True, key_start: Column | None = None) -> DataFrame:
    """History-keeping dimension: close changed versions, open new ones.

    One batch (source deduplicated to one row per key) against the target.
    New versions start at the effective date, end NULL, are current and get
    keys after the target's largest key.  Flags: ``null_safe`` treats a change
    to/from NULL as a change; ``require_newer`` ignores source rows whose
    effective date is not after the current version's start.  ``key_start``
    overrides the largest existing key (when ``target`` holds only part of
    the table, e.g. its current versions).

    Plan: the batch is written once; :func:`scd2_close` joins it to the current
    versions (closed history passes through untouched) and
    :func:`scd2_new_versions` joins the current versions' keys and tracked columns
    to it; both joins are equi joins with at most one row per key on each side.
    Only the opened versions are written again, by :func:`assign_keys`.
    """
    src = _once(_without_null_keys(source, key, quarantine_null_keys).select(key, *tracked, effective_col), freeze)
    flags = dict(effective_col=effective_col, start_col=start_col, current_col=current_col, null_safe=null_safe,
                 require_newer=require_newer)
    closed = scd2_close(target, src, key, tracked, end_col=end_col, **flags)
    opened = scd2_new_versions(target, src, key, tracked, **flags).select(
        "*", F.lit(None).cast(target.schema[end_col].dataType).alias(end_col), F.lit(True).alias(current_col))
    start = key_start if key_start is not None else max_key(target, sk_col)
    opened = assign_keys(opened, [key, start_col], sk_col, start=start, num_partitions=num_partitions)
    return closed.unionByName(opened.select(*target.columns))
