"""Dimension lookups: current version, as-of (validity interval), plain key.

Every lookup takes ``salt``: with ``salt > 1`` the fact rows are spread over
``salt`` buckets by a hash of the whole row and the dimension rows are
replicated once per bucket, so a key holding a large share of the facts is
joined by ``salt`` tasks even when adaptive skew handling is off.  Each fact
row still meets each matching dimension row exactly once (exact result); the
cost is ``salt`` copies of the dimension side.

The dimension grows with the input, so it is shuffled and merged, never broadcast: Spark's
size check reads the compressed file size of a scan, and a dimension of a few MB of
parquet can be a hash table of a GB on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted(fact: DataFrame, dim: DataFrame, salt: int) -> tuple[DataFrame, DataFrame, Column | None]:
    if salt <= 1:
        return fact, dim, None
    f = fact.withColumn("_fs", F.pmod(F.xxhash64(*fact.columns), F.lit(salt)))
    d = dim.withColumn("_ds", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))))
    return f, d, f["_fs"] == d["_ds"]


def current_lookup(df: DataFrame, dim: DataFrame, key: str, cols: Sequence[str],
                   current_col: str = "IsCurrent", how: str = "left", salt: int = 1) -> DataFrame:
    """``df LEFT JOIN dim ON key AND dim.IsCurrent = true``: the current version.

    The constant predicate is pushed into the dimension scan; the join is a
    sort-merge equi join.
    """
    d = dim.where(F.col(current_col)).select(F.col(key).alias("_lk"), *cols)
    f, d, extra = salted(df, d, salt)
    cond = f[key] == d["_lk"]
    return f.join(d.hint("merge"), cond if extra is None else cond & extra, how).drop("_lk", "_fs", "_ds")


def asof_lookup(fact: DataFrame, dim: DataFrame, key: str, date_col: str,
                cols: Sequence[str], dim_key: str | None = None,
                start_col: str = "StartDate", end_col: str = "EndDate",
                how: str = "left", salt: int = 1) -> DataFrame:
    """Version valid on the fact's date: ``key = key AND d >= start AND (d <= end OR end IS NULL)``.

    Both ends are inclusive, so a fact on a change date matches the closing and
    the opening version (the duplicate is removed by the caller's dedup).  The
    plan is an equi join on the key with the interval as residual condition;
    versions per key are few, so no range-join machinery is needed, and a hot
    fact key is split by adaptive skew-join handling.
    """
    dk = dim_key or key
    d = dim.select(F.col(dk).alias("_ak"), F.col(start_col).alias("_as"),
                   F.col(end_col).alias("_ae"), *cols)
    f, d, extra = salted(fact, d, salt)
    dt = f[date_col]
    cond = ((f[key] == d["_ak"]) & (dt >= d["_as"]) & ((dt <= d["_ae"]) | d["_ae"].isNull()))
    if extra is not None:
        cond = cond & extra
    return f.join(d.hint("merge"), cond, how).drop("_ak", "_ae", "_fs", "_ds").withColumnRenamed("_as", "_asof_start")


def left_lookup(fact: DataFrame, dim: DataFrame, key: str, cols: Sequence[str],
                dim_key: str | None = None, how: str = "left", salt: int = 1) -> DataFrame:
    """``fact LEFT JOIN dim ON fact.key = dim.key`` bringing ``cols``."""
    dk = dim_key or key
    d = dim.select(F.col(dk).alias("_lk"), *cols)
    f, d, extra = salted(fact, d, salt)
    cond = f[key] == d["_lk"]
    return f.join(d.hint("merge"), cond if extra is None else cond & extra, how).drop("_lk", "_fs", "_ds")
