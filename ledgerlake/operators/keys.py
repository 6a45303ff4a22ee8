"""Surrogate keys and a reproducible train/test split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_ROW_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def assign_keys(df: DataFrame, order: Sequence[str], key_col: str,
                start: int | Column = 0, num_partitions: int | None = None,
                freeze: bool = True) -> DataFrame:
    """Dense BIGINT keys ``start+1 .. start+n`` in the order of ``order``.

    The table identity column of the reference, rebuilt without a global
    single-partition ``row_number``:

    1. range-partition on ``order`` and sort inside each partition;
    2. the position inside the partition comes from
       ``monotonically_increasing_id`` (partition index in the high bits);
    3. per-partition counts (one row per partition) give prefix offsets,
       broadcast back: the broadcast side is bounded by ``num_partitions``.

    ``freeze`` writes the positioned rows once to the shared work folder so
    that both uses (counts and keyed rows) read identical rows.  Keep it on:
    unfrozen, the two uses are separate range exchanges, and the range
    partitioner re-samples imbalanced inputs with a seed tied to the RDD id,
    so the two branches can disagree on the range bounds (duplicate keys).
    ``start`` may be a scalar subquery column such as the target's max key.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    pos = ranged.select("*", F.spark_partition_id().alias("_kp"),
                        F.monotonically_increasing_id().alias("_kid"))
    if freeze:
        pos = materialize(pos, "keys")
    return _numbered(pos, key_col, start).select(key_col, *df.columns)


def in_row_order(df: DataFrame, key_col: str) -> DataFrame:
    """Dense numbers 1 .. n in the order in which the (globally sorted) rows of ``df`` come;
    the positioned rows are written once, as by :func:`assign_keys`, and no task sees them all."""
    pos = materialize(df.select("*", F.spark_partition_id().alias("_kp"), F.monotonically_increasing_id().alias("_kid")), "places")
    return _numbered(pos, key_col, 0).select(key_col, *df.columns)


def _numbered(pos: DataFrame, key_col: str, start: int | Column) -> DataFrame:
    """Positioned rows (partition ``_kp``, id ``_kid``) with their number after ``start``."""
    counts = pos.groupBy("_kp").agg(F.count(F.lit(1)).alias("_kn"))
    w = Window.orderBy("_kp").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_kp", F.coalesce(F.sum("_kn").over(w), F.lit(0)).alias("_koff"))
    local = F.col("_kid") - F.shiftleft(F.col("_kp").cast("long"), _ROW_BITS)
    start_col = start if isinstance(start, Column) else F.lit(int(start))
    return (pos.join(F.broadcast(offsets), "_kp")
            .withColumn(key_col, (F.coalesce(start_col, F.lit(0)) + F.col("_koff") + local + 1).cast("long")))


def max_key(df: DataFrame, key_col: str) -> Column:
    """Scalar-subquery column with the largest key in ``df`` (0 when empty)."""
    return F.coalesce(df.agg(F.max(key_col)).scalar(), F.lit(0))


def split_hash(id_col: Column | str, seed: int = 42) -> Column:
    """Deterministic number ``0 .. 2^32 - 1`` from md5(seed:id).

    Independent of partitioning and input order (unlike ``randomSplit``);
    DuckDB computes the same number with
    ``('0x' || substr(md5(seed || ':' || id), 1, 8))::BIGINT``.
    """
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string"))), 1, 8), 16, 10).cast("long")


def in_test(id_col: Column | str, seed: int = 42, test_fraction: float = 0.2) -> Column:
    """True for the ``test_fraction`` of ids with the smallest hashes; false for a NULL id."""
    return F.coalesce(split_hash(id_col, seed) < F.lit(int(test_fraction * (1 << 32))), F.lit(False))


def hash_split(df: DataFrame, id_col: str, seed: int = 42, test_fraction: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(train, test) with ``test_fraction`` of the hash range in test; every row is in one of them."""
    test = in_test(id_col, seed, test_fraction)
    return df.where(~test), df.where(test)
