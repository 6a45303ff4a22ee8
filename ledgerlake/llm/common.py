"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, work_path  # noqa: F401  (re-exported)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names that clash with no column of ``df`` (names are case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        while base.lower() in taken:
            base += "_"
        taken.add(base.lower())
        out.append(base)
    return out


def quoted(name: str):
    """The column called exactly ``name`` (dots and spaces in it are no path)."""
    return F.col("`" + name.replace("`", "``") + "`")


def table_bytes(df: DataFrame, *cols: str, per_row: int = 0) -> int:
    """Sum of the UTF-8 / binary lengths of ``cols`` over all rows (one narrow pass), and ``per_row`` for each row."""
    total = sum((F.coalesce(F.octet_length(quoted(c)), F.lit(0)).cast("long") for c in cols), F.lit(per_row).cast("long"))
    return df.agg(F.sum(total)).first()[0] or 0


def texts(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column's values; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        for chunk in column.chunks:
            yield from texts(chunk)
        return
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        v = value.as_py()
        yield v if v is not None else b""


def text_slices(batch: pa.RecordBatch, column: int, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``size`` bytes of a string column (one row at least)."""
    if not batch.num_rows:
        return
    ends = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype("int64").cumsum()
    first = 0
    while first < batch.num_rows:
        before = int(ends[first - 1]) if first else 0
        stop = max(first + 1, int(ends.searchsorted(before + size, side="right")))
        yield batch.slice(first, stop - first)
        first = stop


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under the folder named by ``spark.checkpoint.dir``."""
    return work_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps that nothing refers to any more.

    Spark's cleaner works when the driver collects its garbage; a step that ended
    in a written table calls this before the next step fills the disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
