"""Latest row per key (row_number = 1), with an explicit, total tie-break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return False
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return not (hasattr(T, "VariantType") and isinstance(t, T.VariantType))


def _order(df: DataFrame, order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   valid: Column | None = None, filter_before_rank: bool = False,
                   tiebreak_all: bool = True, keep_rank: bool = True,
                   rank_col: str = "rn") -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (strings mean DESC NULLS LAST).

    ``valid`` is the quality predicate.  By default it is applied *after* the
    ranking (a key whose newest row is invalid disappears, as the reference
    does); ``filter_before_rank=True`` drops invalid rows first.

    ``tiebreak_all`` appends every remaining orderable column (ascending) to
    the order so the winner never depends on input order or partitioning.

    Plan: Catalyst turns ``row_number() ... = 1`` into a partial
    ``WindowGroupLimit`` before the shuffle, so a hot key sends at most one row
    per map partition across the network.
    """
    ordering = _order(df, order)
    if tiebreak_all:
        used = set(keys) | {o for o in order if isinstance(o, str)}
        ordering += [F.col(f.name).asc_nulls_first() for f in df.schema.fields
                     if f.name not in used and _orderable(f.dataType)]
    src = df.where(valid) if (valid is not None and filter_before_rank) else df
    w = Window.partitionBy(*keys).orderBy(*ordering)
    ranked = src.withColumn(rank_col, F.row_number().over(w))
    cond = F.col(rank_col) == 1
    if valid is not None and not filter_before_rank:
        cond = cond & valid
    out = ranked.where(cond)
    return out if keep_rank else out.drop(rank_col)
