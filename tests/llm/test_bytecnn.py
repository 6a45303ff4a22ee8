"""The byte-level convolutional classifier."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import bytecnn as cnn
from ledgerlake.llm.bytecnn import fit, keep_good, score, score_documents, train


def corpus(n=260, seed=1):
    rng = random.Random(seed)
    words = ["stone", "river", "über", "the", "of", "light", "naïve", "walk"]
    rows = []
    for i in range(n):
        bad = i % 4 == 0
        text = ". ".join(" ".join(rng.choice(words) for _ in range(rng.randrange(3, 9))) for _ in range(rng.randrange(1, 30)))
        if bad:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + " ### !!" * 6 + text[at:]
        rows.append((i, text, 0 if bad else 1))
    return rows


def test_chunks_cover_the_whole_text():
    for n in [0, 1, 15, 16, 17, 20, 21, 999]:
        data = cnn.padded(b"x" * n)
        starts = np.arange(cnn.chunk_count(n)) * cnn.STRIDE
        assert len(data) >= n and starts[-1] + cnn.WIDTH == len(data)
        assert len(cnn.chunk_answers(data, cnn.start_weights(1))) == len(starts)


def test_slabs_do_not_change_the_maxima(monkeypatch):
    w, text = cnn.start_weights(3), random.Random(2).randbytes(5000)
    best, at = cnn.pooled(text, w)
    monkeypatch.setattr(cnn, "SLAB", 64)
    again, at2 = cnn.pooled(text, w)
    assert np.allclose(best, again, atol=1e-5) and (at == at2).all()
    data = cnn.padded(text)
    plain = np.stack([w["embed"][data[a : a + cnn.WIDTH]].reshape(-1) @ w["filters"] for a in range(0, len(data) - cnn.WIDTH + 1, cnn.STRIDE)])
    assert np.allclose(best, plain.max(axis=0), atol=1e-4)


def test_the_end_of_a_long_text_counts():
    w = train([t.encode() for _, t, _ in corpus()], [q for *_, q in corpus()])
    good = "stone river light. " * 3000
    a, b = score([good.encode(), (good + " ### !!" * 6).encode()], w)
    assert a > 0.5 > b


def frames(spark):
    rows = corpus()
    docs = [(i, t) for i, t, _ in rows] + [(None, "no id"), (900, None), (901, ""), (3, rows[3][1])]
    df = (spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("score", F.lit("clash"))
          .withColumn("source", F.lit("s")).withColumn("verdict", F.lit(1)))
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(None, 1, 0), (5, None, 0), (7, 1, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    return rows, df, labels


def test_held_out_accuracy_and_columns(spark):
    rows, df, labels = frames(spark)
    weights = fit(df, labels)
    out = score_documents(df, weights)
    assert set(out.columns) == {"doc_id", "text", "source", "verdict", "held_out", "score", "predicted"}
    found = out.collect()
    assert len(found) == len(rows) + 4 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    label = {i: q for i, _, q in rows}
    held = [r for r in found if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in held) / len(held) > 0.9
    by_text = {}
    for r in found:
        assert by_text.setdefault(r.text or "", r.score) == r.score
    kept = keep_good(df, weights)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in found if r.predicted)


def test_held_out_labels_are_never_learned(spark):
    rows, df, labels = frames(spark)
    turned = labels.withColumn("quality", F.when(cnn.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = fit(df, labels, least_steps=5, epochs=1), fit(df, turned, least_steps=5, epochs=1)
    assert all((a[k] == b[k]).all() for k in a)


def test_sample_bounds_and_empty_tables(spark):
    _, df, labels = frames(spark)
    items, marks = cnn.training_rows(df, labels, 20, 1 << 20)
    assert 0 < len(items) <= 20 and len(items) == len(marks)
    items, _ = cnn.training_rows(df, labels, 100, 2000)
    assert sum(map(len, items)) <= 2000
    weights = fit(df, labels.limit(0))
    assert score_documents(df.limit(0), weights).count() == 0
    assert score_documents(df, weights).count() == df.count()


def test_a_long_text_does_not_end_the_sample(spark):
    rows = [(i, "x" * (20_000 if i == 5 else 300), i % 2) for i in range(1, 50)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    fold = {r[0] for r in df.select("doc_id").where(~cnn.held_out(F.col("doc_id"))).collect()}
    items, _ = cnn.training_rows(df, labels, 100, 16_000)
    assert len(items) == len(fold - {5})
    with pytest.raises(ValueError, match="none of"):
        cnn.training_rows(df, labels, 100, 200)
