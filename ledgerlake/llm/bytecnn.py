"""Quality classifier: a byte-level convolutional network in numpy.

A text is its UTF-8 bytes.  Overlapping chunks of ``WIDTH`` bytes, one every
``STRIDE`` bytes, cover the whole text; each byte is looked up in a learned
embedding, learned filters answer to each chunk, the largest answer of each
filter over all chunks is kept, and a small dense layer combines these maxima
into one probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, quoted, text_slices, texts

WIDTH, STRIDE, EMBED, FILTERS, HIDDEN = 16, 4, 8, 32, 16
#: Bytes of one slab of chunks while scoring.
SLAB = 1 << 17

Weights = dict[str, np.ndarray]


def start_weights(seed: int) -> Weights:
    rng = np.random.default_rng(seed)

    def normal(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)

    return {"embed": normal(256, EMBED, scale=0.5), "filters": normal(WIDTH * EMBED, FILTERS, scale=0.12),
            "bias": np.zeros(FILTERS, np.float32), "hidden": normal(FILTERS, HIDDEN, scale=0.25),
            "hidden_bias": np.zeros(HIDDEN, np.float32), "out": normal(HIDDEN, 1, scale=0.3),
            "out_bias": np.zeros(1, np.float32)}


def chunk_count(size: int) -> int:
    """Chunks of a text of ``size`` bytes: they start at 0, STRIDE, ... and the
    last reaches the text's end (zero bytes fill it up)."""
    return max(1, -(-(size - WIDTH) // STRIDE) + 1)


def chunk_answers(data: np.ndarray, w: Weights) -> np.ndarray:
    """(chunks, FILTERS) answers for a byte array whose length is WIDTH + k * STRIDE.

    A chunk is WIDTH / STRIDE pieces of STRIDE bytes; the filters answer to each
    piece once, and a chunk's answer is the sum over its pieces.
    """
    pieces = WIDTH // STRIDE
    rows = w["embed"][data].reshape(-1, STRIDE * EMBED)
    by_piece = w["filters"].reshape(pieces, STRIDE * EMBED, FILTERS).transpose(1, 0, 2).reshape(STRIDE * EMBED, -1)
    each, n = rows @ by_piece, len(rows) - pieces + 1
    return sum(each[j : j + n, j * FILTERS : (j + 1) * FILTERS] for j in range(pieces))


def padded(text: bytes) -> np.ndarray:
    size = WIDTH + (chunk_count(len(text)) - 1) * STRIDE
    out = np.zeros(size, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out


def pooled(text: bytes, w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Largest answer of each filter over the whole text, and the chunk that gave it."""
    data = padded(text)
    best, at, first = None, None, 0
    for a in range(0, len(data) - WIDTH + 1, SLAB):
        answers = chunk_answers(data[a : a + SLAB + WIDTH - STRIDE], w)
        k = answers.argmax(axis=0)
        top = answers[k, np.arange(FILTERS)]
        if best is None:
            best, at = top, k
        else:
            better = top > best
            best, at = np.where(better, top, best), np.where(better, k + first, at)
        first += len(answers)
    return best, at


def combine(pool: np.ndarray, w: Weights) -> np.ndarray:
    """Probabilities of label 1 from a (texts, FILTERS) array of maxima."""
    seen = np.maximum(pool + w["bias"], 0)
    hidden = np.maximum(seen @ w["hidden"] + w["hidden_bias"], 0)
    z = (hidden @ w["out"] + w["out_bias"])[:, 0].astype(np.float64)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(items: list[bytes], w: Weights) -> np.ndarray:
    if not items:
        return np.zeros(0)
    return combine(np.stack([pooled(t, w)[0] for t in items]), w)


def train(items: list[bytes], labels: list[int], epochs: int = 12, least_steps: int = 900, rate: float = 3e-3,
          batch: int = 32, seed: int = 1) -> Weights:
    """Adam on the log loss, for ``epochs`` or, on small samples, ``least_steps`` batches.

    Only the chunk that gave a maximum passes a gradient back.
    """
    w = start_weights(seed)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    data, y = [padded(t) for t in items], np.asarray(labels, np.float32)
    if not items:
        return w
    w["out_bias"][0] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    rng, step = np.random.default_rng(seed), 0
    rounds = -(-len(items) // batch)
    epochs = max(epochs, -(-least_steps // rounds))
    steps = epochs * rounds
    for _ in range(epochs):
        order = rng.permutation(len(items))
        for a in range(0, len(order), batch):
            some = order[a : a + batch]
            found = [pooled(items[i], w) for i in some]
            pool, at = np.stack([f[0] for f in found]), np.stack([f[1] for f in found])
            seen = np.maximum(pool + w["bias"], 0)
            hidden = np.maximum(seen @ w["hidden"] + w["hidden_bias"], 0)
            p = 1 / (1 + np.exp(-np.clip((hidden @ w["out"] + w["out_bias"])[:, 0], -30, 30)))
            dz = ((p - y[some]) / len(some))[:, None].astype(np.float32)
            g = {"out": hidden.T @ dz, "out_bias": dz.sum(axis=0)}
            dh = (dz @ w["out"].T) * (hidden > 0)
            g["hidden"], g["hidden_bias"] = seen.T @ dh, dh.sum(axis=0)
            dp = (dh @ w["hidden"].T) * (seen > 0)
            g["bias"] = dp.sum(axis=0)
            where = at[:, :, None] * STRIDE + np.arange(WIDTH)  # (texts, FILTERS, WIDTH) byte places
            picked = np.stack([data[i][where[k]] for k, i in enumerate(some)])
            vectors = w["embed"][picked].reshape(len(some), FILTERS, WIDTH * EMBED)
            g["filters"] = np.einsum("bf,bfd->df", dp, vectors)
            back = dp[:, :, None] * w["filters"].T[None]
            g["embed"] = np.zeros_like(w["embed"])
            np.add.at(g["embed"], picked.reshape(-1), back.reshape(-1, EMBED))
            step += 1
            now = rate * (1 - step / (steps + 1))
            for k, v in g.items():
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.001 * (v * v - second[k])
                w[k] = w[k] - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return w


def held_out(id_col):
    """True where crc32 of the id as text leaves remainder 0 by 5; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, max_rows: int, max_bytes: int,
                  seed: int = 1) -> tuple[list[bytes], list[int]]:
    """A seeded sample of labelled texts outside the held-out fold.

    At most ``max_rows`` texts and ``max_bytes`` bytes come to the driver: a text
    that doesn't fit into what is left of ``max_bytes`` is left out, the rows behind it
    are not.  Labelled rows of which none fits raise.  A document labelled several
    times takes its smallest label; of several rows with one id, the one with the
    smallest text hash is taken.  A null text is an empty one; null ids and labels
    take no part; no labelled row at all gives two empty lists.
    """
    marked = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))
    chosen = marked.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(max_rows)
    body = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sizes = (body.join(F.broadcast(chosen), "doc_id")  # max_rows rows
             .select("doc_id", "quality", F.octet_length("text").alias("size"), F.xxhash64("text").alias("h"))
             .groupBy("doc_id", "quality").agg(F.min(F.struct("h", "size")).alias("one")).collect())
    keep, total = {}, 0
    for r in sorted(sizes, key=lambda r: (hash_order(r.doc_id, seed), r.doc_id)):
        if total + r.one.size > max_bytes:
            continue
        total += r.one.size
        keep[r.doc_id] = (r.quality, r.one.h)
    if not keep:
        if sizes:
            raise ValueError(f"none of {len(sizes)} labelled texts fits into max_bytes={max_bytes}")
        return [], []
    spark = documents.sparkSession
    wanted = spark.createDataFrame([(d, h) for d, (_, h) in keep.items()], "doc_id long, h long")
    rows = (body.withColumn("h", F.xxhash64("text")).join(F.broadcast(wanted), ["doc_id", "h"])
            .dropDuplicates(["doc_id", "h"]).collect())
    rows.sort(key=lambda r: (hash_order(r.doc_id, seed), r.doc_id))
    return [r.text.encode() for r in rows], [keep[r.doc_id][0] for r in rows]


def hash_order(doc_id: int, seed: int) -> int:
    """A seeded order of ids on the driver."""
    return (doc_id * 0x9E3779B97F4A7C15 + seed * 0xC2B2AE3D27D4EB4F) % (1 << 64)


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = 4000, max_bytes: int = 16 << 20, seed: int = 1,
        **options) -> Weights:
    """Weights learned from a bounded sample of labelled rows (``training_rows``).

    Without any labelled row (empty tables, null labels) nothing is learned and the
    seeded start weights are returned; an empty text is learned like any other.
    """
    items, marks = training_rows(documents, labels, max_rows, max_bytes, seed)
    return train(items, marks, seed=seed, **options)


def score_documents(df: DataFrame, weights: Weights, threshold: float = 0.3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """All columns of ``df`` plus ``held_out``, ``score`` and ``predicted``.

    Only the text enters a score.  Null and empty texts are scored as an empty
    text; a text of any length is scored over all its chunks, slab by slab; equal
    texts score alike; a null id is not held out.  A column of ``df`` that has
    one of the three names is replaced.  The weights (a few thousand numbers)
    travel with the task; there is no shuffle, so no key can be hot.  An empty
    table gives an empty result.
    """
    names = [c for c in df.columns if c.lower() not in ("held_out", "score", "predicted")]
    rows = df.select(*map(quoted, names))
    k = next(i for i, c in enumerate(names) if c.lower() == text_col.lower())

    def run(batches):
        for batch in (part for whole in batches for part in text_slices(whole, k)):
            found = score(list(texts(batch.column(k))), weights)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.round(6), pa.float64())],
                                             names=[*names, "score"])

    from pyspark.sql.types import DoubleType, StructField, StructType
    out = rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("score", DoubleType())]))
    return (out.withColumn("held_out", held_out(quoted(id_col)))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(df: DataFrame, weights: Weights, threshold: float = 0.3, **options) -> DataFrame:
    """The rows of ``df`` that the classifier doesn't reject, with the columns of ``df``."""
    (verdict,) = fresh(df, "verdict")
    scored = score_documents(df.withColumn(verdict, F.lit(0)), weights, threshold, **options)
    return scored.where(F.col("predicted") == 1).select(*map(quoted, df.columns))
