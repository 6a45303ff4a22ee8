"""Exact top-k inner products by block-at-a-time pruning.

Vectors are turned into integers and stored, in ranges of the document order, as
blocks: a forward index (ids and the dense matrix) with each term's largest and
smallest weight.  For a query the sum over terms of the larger possible product
bounds every score in a block.  Each task takes, per query, its blocks by falling
bound and scores them through their forward index until the next bound is below
the k-th best score; the tasks' results are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, quoted, shared_path

BLOCK = "ids binary, weights binary, high binary, low binary, terms int"


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, vector): floor(scale * x) of each component as a long.  Rows without id
    or vector, or with a null or non-finite component, take no part."""
    v = quoted(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (df.where(quoted(id_col).isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)))
            .select(quoted(id_col).cast("long").alias("id"),
                    F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("vector")))


def matrix(vectors: pa.ListArray) -> np.ndarray:
    """(rows, terms) of a list column; shorter vectors are filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max()) if len(sizes) else 0), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """The block forward index: ``block_rows`` consecutive rows of a scan task each (no shuffle)."""

    def build(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, block_rows):
                part = batch.slice(a, block_rows)
                ids, m = part.column(0).to_numpy(), matrix(part.column(1))
                if float(np.abs(m.astype(np.float64)).max(initial=0)) ** 2 * m.shape[1] >= 2**63:
                    raise OverflowError("vector components are too large: their scores would not fit a long")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes()], pa.binary()) for x in (ids, m, m.max(axis=0), m.min(axis=0))]
                    + [pa.array([m.shape[1]], pa.int32())], names=["ids", "weights", "high", "low", "terms"])

    return rows.mapInArrow(build, BLOCK)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer a @ b.T: in doubles while every partial sum fits 53 bits."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T if most < 2**63 else a.astype(object) @ b.T.astype(object)


def widen(m: np.ndarray, terms: int) -> np.ndarray:
    return m if m.shape[1] >= terms else np.pad(m, ((0, 0), (0, terms - m.shape[1])))


class Best:
    """The k best (score, id) of each query; ties go to the smaller id."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k, self.found = ids, k, [[] for _ in ids]
        self.kth = np.full(len(ids), -np.inf)

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        near = np.flatnonzero((scores >= self.kth[q]) & (ids != self.ids[q]))
        if len(near):
            both = self.found[q] + [(-int(scores[i]), int(ids[i])) for i in near]
            self.found[q] = sorted(both)[: self.k]
            if len(self.found[q]) == self.k:
                self.kth[q] = -self.found[q][-1][0]


def search(queries: np.ndarray, index: list, best: Best) -> int:
    """Score blocks (ids, weights, high, low) for all queries; returns the (query, block) pairs scored."""
    bound = np.stack([product(np.maximum(queries, 0), high[None])[:, 0] + product(np.minimum(queries, 0), low[None])[:, 0]
                      for _, _, high, low in index], axis=1)
    order, scored = np.argsort(-bound, axis=1, kind="stable"), 0
    active = np.arange(len(queries))
    for step in range(len(index)):
        block = order[active, step]
        going = bound[active, block] >= best.kth[active]  # the following bounds are no larger
        active, block = active[going], block[going]
        if not len(active):
            break
        scored += len(active)
        for b in np.unique(block):
            mine = active[block == b]
            ids, weights = index[b][:2]
            for q, scores in zip(mine, product(queries[mine], weights)):
                best.add(q, scores, ids)
    return scored


def load(batch: pa.RecordBatch, terms: int) -> list:
    """The blocks of a batch, at least ``terms`` wide."""
    out = []
    for ids, weights, high, low, width in zip(*(c.to_pylist() for c in batch.columns)):
        of = [widen(np.frombuffer(x, np.int64).reshape(-1, width) if width else np.zeros((len(ids) // 8, 0), np.int64), terms)
              for x in (weights, high, low)]
        out.append((np.frombuffer(ids, np.int64), of[0], of[1][0], of[2][0]))
    return out


def top_k(df: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, block_rows: int = 512,
          slab_bytes: int = 16 << 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best rows of ``df`` by integer inner product.

    All rows but those with the query's own id are candidates; ties go to the
    smaller id; a query with fewer candidates gets all of them.  Repeated rows
    are candidates one by one; of several query rows with one id the smallest
    vector is the query.  Null vectors or ids and null or non-finite components
    take no part; shorter vectors count as filled up with zeros; other columns
    are not read.  An empty table gives an empty result.  Finite components so large
    that a score might not fit a long raise.

    Queries go through the index slab by slab: a slab holds at most
    ``slab_bytes`` of query vectors (at least one block), which is all that the
    driver holds and broadcasts.  Each slab's result is written to the shared
    folder, and so is the index, which a lost executor reads again.
    """
    spark = df.sparkSession
    index = materialize(blocks(integer_vectors(df, id_col, vector_col, scale), block_rows), "block-index")
    asked = integer_vectors(queries, id_col, vector_col, scale).groupBy("id").agg(F.min("vector").alias("vector"))
    asked = materialize(blocks(asked, block_rows), "query-blocks")
    folder, slabs, held = shared_path(spark, "top-k"), 0, []

    def run_slab() -> None:
        nonlocal slabs, held
        sent = spark.sparkContext.broadcast(held)

        def score(batches):
            parts = load(pa.RecordBatch.from_pylist(sent.value, schema), 0)
            width = max(p[1].shape[1] for p in parts)
            wanted = np.concatenate([widen(p[1], width) for p in parts])
            best = Best(np.concatenate([p[0] for p in parts]), k)
            for batch in batches:
                found = load(batch, width)
                most = max([width, *(f[1].shape[1] for f in found)])
                if found:
                    search(widen(wanted, most), [(i, widen(m, most), widen(h[None], most)[0], widen(lo[None], most)[0])
                                                 for i, m, h, lo in found], best)
            rows = [(int(q), i, -s) for q, own in zip(best.ids, best.found) for s, i in own]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(3)],
                                             names=["query_id", "vec_id", "score"])

        schema = pa.schema([("ids", pa.binary()), ("weights", pa.binary()), ("high", pa.binary()), ("low", pa.binary()),
                            ("terms", pa.int32())])
        ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        (index.mapInArrow(score, "query_id long, vec_id long, score long").withColumn("rank", ranked)
         .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
         .write.parquet(f"{folder}/slab={slabs}"))
        sent.unpersist()
        slabs, held = slabs + 1, []

    size = 0
    for row in asked.toLocalIterator():
        size += len(row.weights)
        if held and size > slab_bytes:
            run_slab()
            size = len(row.weights)
        held.append({c: bytes(row[c]) if c != "terms" else row[c] for c in asked.columns})
    if held:
        run_slab()
    if not slabs:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return spark.read.parquet(folder).drop("slab")
