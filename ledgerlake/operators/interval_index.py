"""As-of lookup through an index of validity intervals.

A plain as-of join meets every fact of a key with every version of that key.  Here
the intervals of keys with many versions are cut into calendar cells, facts get the one
cell of their date, and the join is an equi join on (key, cell); the interval's own
bounds are tested only inside a cell.

The cells follow the data.  Time is cut into blocks of 1024 days; a block in which a key
has few versions is one cell.  In the others the cell width is the smallest power of
two (days) at which cutting makes at most four rows per version, so a key with a version a
day gets cells of a day and one with a version a month gets cells of some weeks.  Keys with
few versions are not cut at all and cost what the plain join costs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .lookup import asof_lookup, salted

#: Days of a block as a power of two, and the cell numbers set aside for a block.
BLOCK_BITS, CELLS = 10, 4096
#: Cell widths tried, as powers of two.
WIDTHS = (0, 1, 2, 3, 4, 5, 6, 8, 10)
#: Index rows per version that a cut may cost.
COPIES = 4
#: Keys of a cut plan up to which Spark may broadcast it.
FEW_KEYS = 10_000


def _day(c: Column) -> Column:
    return F.unix_date(c.cast("date"))


def _block(day: Column) -> Column:
    return F.shiftright(day, BLOCK_BITS)


def _cell(day: Column, block: Column, width: Column) -> Column:
    """Number of the cell of ``day`` in ``block``; a block without a width is one cell."""
    inside = F.call_function("shiftright", day.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)), width)
    return F.when(width.isNull(), block * CELLS).otherwise(block * CELLS + 1 + inside).cast("long")


def cut_plan(dim: DataFrame, key: str, start_col: str, end_col: str, light: int = 16) -> DataFrame:
    """(key, lo, hi, widths) of the keys with over ``light`` versions.

    ``lo`` and ``hi`` are the first and last day on which a version of the key starts:
    a version that is valid later is valid on ``hi``, too, so open and far ends need no
    cells beyond it.  ``widths`` maps the blocks that are cut to their cell width.  Its size
    is bounded by the calendar, not by the versions.
    """
    v = dim.select(F.col(key).alias("key"), _day(F.col(start_col)).alias("s"), _day(F.col(end_col)).alias("e"))
    v = v.where(F.col("s").isNotNull() & (F.col("e").isNull() | (F.col("e") >= F.col("s"))))
    keys = (v.where("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi"))
            .where(F.col("n") > light).drop("n"))
    cut = (v.join(keys.hint("merge"), "key").withColumn("e", F.least("e", "hi"))
           .withColumn("block", F.explode(F.sequence(_block(F.col("s")), _block(F.col("e"))))))
    first = F.shiftleft("block", BLOCK_BITS)
    s, e = F.greatest("s", first), F.least("e", first + ((1 << BLOCK_BITS) - 1))
    cost = [F.sum(F.shiftright(e, w) - F.shiftright(s, w) + 1).alias(f"w{w}") for w in WIDTHS]
    per_block = cut.groupBy("key", "lo", "hi", "block").agg(F.count("*").alias("n"), *cost)
    width = F.coalesce(*(F.when(F.col(f"w{w}") <= COPIES * F.col("n"), F.lit(w)) for w in WIDTHS))
    entry = F.when(F.col("n") > light, F.struct("block", width.alias("width")))  # null entries are not collected
    return (per_block.groupBy("key", "lo", "hi").agg(F.map_from_entries(F.collect_list(entry)).alias("widths")))


def index_cells(start: Column, end: Column) -> Column:
    """All cells that an interval covers, of a row that carries its key's plan (lo, hi, widths)."""
    last = F.least(end, F.col("_hi"))  # skips a null end

    def of_block(b: Column) -> Column:
        first = F.shiftleft(b, BLOCK_BITS)
        s, e = F.greatest(start, first), F.least(last, first + ((1 << BLOCK_BITS) - 1))
        w = F.try_element_at("_widths", b)
        cells = F.transform(F.sequence(F.call_function("shiftright", s, F.coalesce(w, F.lit(0))), F.call_function("shiftright", e, F.coalesce(w, F.lit(0)))),
                            lambda c: (b * CELLS + 1 + c.bitwiseAND(F.call_function("shiftright", F.lit((1 << BLOCK_BITS) - 1), w))).cast("long"))
        return F.when(w.isNull(), F.array((b * CELLS).cast("long"))).otherwise(cells)

    covered = F.flatten(F.transform(F.sequence(_block(start), _block(last)), of_block))
    return (F.when(F.col("_lo").isNull(), F.array(F.lit(0).cast("long")))
            .when(start <= last, covered).otherwise(F.array().cast("array<bigint>")))


def indexed_sides(fact: DataFrame, dim: DataFrame, plan: DataFrame, key: str, date_col: str, cols: Sequence[str],
                  dim_key: str, start_col: str, end_col: str) -> tuple[DataFrame, DataFrame]:
    """Facts with ``_cell`` and versions with one row per ``_cell`` they cover."""
    own = plan.select(F.col("key").alias("_pk"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("widths").alias("_widths"))
    f = fact.join(own, fact[key] == own["_pk"], "left")
    day = F.least(F.greatest(_day(F.col(date_col)), F.col("_lo")), F.col("_hi"))  # beyond the bounds the nearest cell decides
    # greatest and least skip nulls; a fact without a date matches nothing, whatever its cell
    cell = F.when(F.col("_lo").isNull(), F.lit(0).cast("long")).otherwise(_cell(day, _block(day), F.try_element_at("_widths", _block(day))))
    f = f.withColumn("_cell", cell).drop("_pk", "_lo", "_hi", "_widths")
    d = dim.select(F.col(dim_key).alias("_ak"), F.col(start_col).alias("_as"), F.col(end_col).alias("_ae"), *cols)
    d = (d.join(own, d["_ak"] == own["_pk"], "left").withColumn("_dcell", F.explode(index_cells(_day(F.col("_as")), _day(F.col("_ae")))))
         .drop("_pk", "_lo", "_hi", "_widths"))
    return f, d


def asof_lookup_indexed(fact: DataFrame, dim: DataFrame, key: str, date_col: str, cols: Sequence[str],
                        dim_key: str | None = None, start_col: str = "StartDate", end_col: str = "EndDate",
                        how: str = "left", salt: int = 1, light: int = 16) -> DataFrame:
    """The rows of :func:`~ledgerlake.operators.lookup.asof_lookup` (both ends inclusive, open ends valid for good).

    The plan of the cut (one row per key with over ``light`` versions) is written once to
    the shared work folder; facts and versions meet it in left joins, which Spark
    may broadcast if the plan has few keys.  Without such keys the plain lookup runs.
    A fact meets the versions of its cell only: at most about ``COPIES`` times the versions of a
    block per cell count, so the candidate pairs grow with the facts and not with
    facts x versions.  A hot key's facts are spread over its cells.
    """
    dk = dim_key or key
    plan = materialize(cut_plan(dim, dk, start_col, end_col, light), "interval-cut")
    keys = plan.count()  # of the written plan
    if keys == 0:
        return asof_lookup(fact, dim, key, date_col, cols, dim_key, start_col, end_col, how, salt)
    f, d = indexed_sides(fact, dim, plan if keys <= FEW_KEYS else plan.hint("merge"), key, date_col, cols, dk, start_col, end_col)
    f, d, extra = salted(f, d, salt)
    dt = f[date_col]
    cond = ((f[key] == d["_ak"]) & (f["_cell"] == d["_dcell"]) & (dt >= d["_as"]) & ((dt <= d["_ae"]) | d["_ae"].isNull()))
    if extra is not None:
        cond = cond & extra
    return f.join(d.hint("merge"), cond, how).drop("_ak", "_ae", "_fs", "_ds", "_cell", "_dcell").withColumnRenamed("_as", "_asof_start")
