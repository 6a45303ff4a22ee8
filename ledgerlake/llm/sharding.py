"""Global shuffle into equal shards by a two-pass external shuffle.

Pass 1 scatters the records uniformly into memory-sized buckets by a seeded hash
(Spark's shuffle is the external scatter).  Pass 2 loads one bucket at a time,
permutes it by a seeded Fisher-Yates shuffle and writes it.  Bucket after bucket
the written records form one random order, which is cut into shards whose
row counts differ by one at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import fresh, quoted, shared_path, table_bytes


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of 0..n-1: from the last place down, swap with a place not after it."""
    order = np.arange(n)
    draws = np.random.default_rng([seed & 0xFFFFFFFF, bucket]).integers(0, np.arange(1, n + 1)) if n else []
    for i in range(n - 1, 0, -1):
        j = draws[i]
        order[i], order[j] = order[j], order[i]
    return order


#: Rows of the table of bucket sizes up to which it is broadcast.
BROADCAST_ROWS = 500_000
#: What a row counts in a bucket besides its text.
ROW_BYTES = 64


def shuffle_records(df: DataFrame, seed: int = 7, bucket_bytes: int = 8 << 20, text_col: str = "text") -> tuple[DataFrame, list[str], int]:
    """All rows and columns of ``df`` plus (bucket, slot in the bucket), written once to the shared folder.

    Returns the written table, the names of the two added columns and the number of buckets.
    """
    bucket, turn, place = fresh(df, "bucket", "turn", "place")
    rows = df.withColumn(place, F.monotonically_increasing_id())
    buckets = max(1, -(-table_bytes(df, text_col, per_row=ROW_BYTES) // bucket_bytes))
    rows = (rows.withColumn(turn, F.xxhash64(F.lit(seed), place))
            .withColumn(bucket, F.pmod(turn, F.lit(buckets))))
    names = [*df.columns, bucket, place]

    def permute(key, table):
        table = table.sort_by([(turn, "ascending"), (place, "ascending")])
        order = fisher_yates(len(table), seed, key[0].as_py())
        table = table.take(pa.array(order))
        return table.drop_columns([turn, place]).append_column(place, pa.array(range(len(table)), pa.int64())).select(names)

    schema = StructType([*df.schema.fields, StructField(bucket, LongType()), StructField(place, LongType())])
    path = shared_path(df.sparkSession, "buckets")
    rows.groupBy(bucket).applyInArrow(permute, schema).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path), [bucket, place], buckets


def shard(df: DataFrame, shards: int = 8, seed: int = 7, bucket_bytes: int = 8 << 20, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df`` in a random order, with ``shard`` (0 to
    ``shards`` - 1; row counts differ by one at most) and ``slot`` (gapless from 0
    within the shard).  Columns of ``df`` with these names are replaced.

    A row's place in the input decides its bucket (the input must be a stable
    scan), so neither a frequent id nor a third of all rows being equal makes a
    bucket hot; null ids and texts, empty and repeated rows are rows like any
    other.  A bucket holds about ``bucket_bytes`` at any scale, a
    row counting its text and a fixed cost (so rows without text fill buckets, too); a single
    longer text is one row of it.  The table of bucket sizes has one row per
    bucket.  An empty table gives an empty result.
    """
    df = df.drop(*[c for c in df.columns if c.lower() in ("shard", "slot")])
    written, (bucket, place), buckets = shuffle_records(df, seed, bucket_bytes, text_col)
    sizes = written.groupBy(bucket).agg(F.count("*").alias("rows"))
    total = sizes.agg(F.sum("rows")).first()[0] or 0
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    (first,) = fresh(written, "first")
    starts = sizes.select(bucket, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(first))
    if buckets <= BROADCAST_ROWS:  # else Spark joins by shuffle
        starts = F.broadcast(starts)
    at = F.col(place) + F.col(first)
    k = F.expr(f"((`{place}` + `{first}`) * {shards}L) div {max(total, 1)}L")
    start = F.expr(f"({total}L * `shard` + {shards - 1}L) div {shards}L")  # first place of the shard, rounded up
    return (written.join(starts, bucket).withColumn("shard", k.cast("int"))
            .withColumn("slot", (at - start).cast("long")).drop(bucket, place, first))


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Write ``shard(df)`` as one folder per shard, in slot order within its files."""
    out = shard(df, **options)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
