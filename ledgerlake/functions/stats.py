"""Small arithmetic helpers shared by gold views and features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_share(part: Column, total: Column, decimal: bool = False, digits: int = 2) -> Column:
    """``ROUND(part * 100 / total, digits)``; NULL (not an error) when total is 0.

    ``decimal=False`` is the ``*100/`` form (DOUBLE result); ``decimal=True``
    is the ``*100.0/`` form, exact decimal arithmetic, returned as DOUBLE.
    """
    if decimal:
        num = part.cast("decimal(20,0)") * F.lit(100).cast("decimal(4,1)")
        return F.round(F.try_divide(num, total.cast("decimal(20,0)")), digits).cast("double")
    return F.round(F.try_divide(part * 100, total), digits)

