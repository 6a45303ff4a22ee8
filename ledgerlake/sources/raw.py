"""Raw (bronze) scans and the columns added on load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_raw(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             fmt: str = "csv") -> DataFrame:
    """CSV folder scan with an explicit all-text schema (no inference pass).

    Quoted fields keep their commas (``"1,200"``); malformed lines become
    NULL columns instead of failing the load.
    """
    r = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", header).option("mode", "PERMISSIVE").option("quote", '"')
    return r.load(path)


def with_lineage(df: DataFrame, source: str | Column | None = None) -> DataFrame:
    """``IngestionDate`` = one timestamp per statement, ``SourceFile`` = the
    given text or, when omitted, each row's own file path."""
    src = F.col("_metadata.file_path") if source is None else (
        source if isinstance(source, Column) else F.lit(source))
    return df.withColumns({"IngestionDate": F.current_timestamp(), "SourceFile": src})


def add_columns(df: DataFrame, fields: T.StructType) -> DataFrame:
    """Schema evolution: add missing columns as typed NULLs (old rows stay NULL)."""
    have = {c.lower() for c in df.columns}
    missing = {f.name: F.lit(None).cast(f.dataType) for f in fields.fields if f.name.lower() not in have}
    return df.withColumns(missing) if missing else df


def backfill_nulls(df: DataFrame, values: dict[str, Column | object],
                   guard: str | None = None) -> DataFrame:
    """``UPDATE t SET c = v WHERE guard IS NULL`` as a projection.

    Without ``guard`` each column is filled only where it is NULL; with
    ``guard`` every listed column is set on the rows whose guard column is NULL
    (the reference's ``WHERE IngestionDate IS NULL``).
    """
    out = {}
    for c, v in values.items():
        vc = v if isinstance(v, Column) else F.lit(v)
        if guard is None:
            out[c] = F.coalesce(F.col(c), vc)
        else:
            out[c] = F.when(F.col(guard).isNull(), vc).otherwise(F.col(c))
    return df.withColumns(out)
