"""Shards of the external shuffle."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm.sharding import fisher_yates, shard, write_shards


def test_fisher_yates_is_a_uniform_permutation():
    counts = collections.Counter(tuple(fisher_yates(3, 1, b)) for b in range(6000))
    assert len(counts) == 6 and min(counts.values()) > 850
    assert fisher_yates(0, 1, 2).tolist() == [] and fisher_yates(1, 1, 2).tolist() == [0]
    assert sorted(fisher_yates(1000, 5, 0)) == list(range(1000))


def rows(n):
    found = [(i, f"text {i} " * (i % 7)) for i in range(n)]
    return found + [(7, "same")] * (n // 3) + [(None, "x"), (n + 1, None), (n + 2, "")]


@pytest.mark.parametrize("n,bucket_bytes", [(200, 500), (200, 1 << 20), (0, 100)])
def test_shards(spark, n, bucket_bytes):
    data = rows(n)
    df = (spark.createDataFrame(data, "doc_id long, text string").repartition(4).withColumn("bucket", F.lit("clash"))
          .withColumn("SLOT", F.lit(3)).withColumn("place", F.lit(None).cast("array<int>")))
    out = shard(df, 8, bucket_bytes=bucket_bytes)
    assert set(out.columns) == {"doc_id", "text", "bucket", "place", "shard", "slot"}
    got = out.collect()
    assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter(data)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.bucket == "clash"
    sizes = [len(by[k]) for k in range(8)]
    assert sum(sizes) == len(data) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    if n and bucket_bytes == 500:  # the equal rows are spread over the shards
        spread = collections.Counter(r.shard for r in got if r.text == "same")
        assert len(spread) == 8
        order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot)) if r.text != "same" and r.doc_id is not None]
        assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.3
    again = {(r.doc_id, r.text, r.shard, r.slot) for r in shard(df, 8, bucket_bytes=bucket_bytes).collect()}
    assert again == {(r.doc_id, r.text, r.shard, r.slot) for r in got}


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame(rows(50), "doc_id long, text string")
    write_shards(df, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()} == {0: 18, 1: 17, 2: 17, 3: 17}
    assert shard(df.limit(0)).count() == 0


def test_rows_without_text_fill_buckets(spark):
    from ledgerlake.llm.sharding import shuffle_records

    df = spark.range(200_000).selectExpr("id AS doc_id", "CAST(NULL AS STRING) AS text")
    written, (bucket, _), buckets = shuffle_records(df, bucket_bytes=1 << 20)
    assert buckets == 13 and written.groupBy(bucket).count().agg(F.max("count")).first()[0] < 25_000
    assert shard(df, 8, bucket_bytes=1 << 20).groupBy("shard").count().collect() == shard(df, 8, bucket_bytes=1 << 20).groupBy("shard").count().collect()


def test_against_a_plain_shuffle(spark):
    """The written order is the plain one: rows into buckets by their hash, a Fisher-Yates shuffle of each, cut into shards."""
    df = spark.createDataFrame([(i, "x" * (i % 90)) for i in range(300)], "doc_id long, text string").coalesce(1)
    place = F.monotonically_increasing_id()
    hashed = [(r.h, r.p, r.doc_id) for r in df.select("doc_id", place.alias("p")).select("doc_id", "p", F.xxhash64(F.lit(7), "p").alias("h")).collect()]
    size = sum(64 + i % 90 for i in range(300))
    buckets = -(-size // 4000)
    order = []
    for b in range(buckets):
        own = [d for _, _, d in sorted(x for x in hashed if x[0] % buckets == b)]
        order += [own[k] for k in fisher_yates(len(own), 7, b)]
    want = {}
    for k, d in enumerate(order):
        s = k * 8 // 300
        want[d] = (s, k - -(-300 * s // 8))
    got = {r.doc_id: (r.shard, r.slot) for r in shard(df, 8, bucket_bytes=4000).collect()}
    assert got == want
