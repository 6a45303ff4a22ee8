"""Grouped counts, shares of total and rounded means (the gold-view primitives)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import half_up_share


def _cols(xs: Sequence[Column | str]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def group_count(df: DataFrame, keys: Sequence[Column | str], value: str, out: str) -> DataFrame:
    """``COUNT(value)`` (non-NULL count) per group; partial + final hash aggregate."""
    return df.groupBy(*_cols(keys)).agg(F.count(value).alias(out))


def share_of_counts(grouped: DataFrame, keys: Sequence[Column | str], out: str, count: str = "_n",
                    decimal: bool = False, digits: int = 2, count_col: str | None = None) -> DataFrame:
    """Share of each group's ``count`` in the grand total of ``count``.

    The grand total is a scalar subquery over the grouped rows (one value),
    not an unpartitioned window: no single-partition exchange however many
    groups there are, and the subquery reuses the main plan's shuffle.  A zero
    total yields NULL shares instead of a division error.
    """
    total = grouped.agg(F.sum(count)).scalar()
    extra = [F.col(count).alias(count_col)] if count_col else []
    return grouped.select(*_cols(keys), *extra, half_up_share(F.col(count), total, decimal, digits).alias(out))


def share_of_total(df: DataFrame, keys: Sequence[Column | str], value: str, out: str,
                   decimal: bool = False, digits: int = 2, count_col: str | None = None) -> DataFrame:
    """``ROUND(COUNT(v) * 100 / SUM(COUNT(v)) OVER (), digits)`` per group."""
    grouped = df.groupBy(*_cols(keys)).agg(F.count(value).alias("_n"))
    names = [c for c in grouped.columns if c != "_n"]
    return share_of_counts(grouped, names, out, "_n", decimal, digits, count_col)


def rounded_mean(df: DataFrame, keys: Sequence[Column | str], value: str, out: str,
                 digits: int = 0) -> DataFrame:
    """``ROUND(AVG(value), digits)`` per group (half-up)."""
    return df.groupBy(*_cols(keys)).agg(F.round(F.avg(value), digits).alias(out))
