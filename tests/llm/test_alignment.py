"""Cross-tokenizer alignment against a plain walk over the libraries' tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ledgerlake.llm.alignment import Batch, align, alignments, load

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = [" ", "  ", "\n", "\n\n", "\r\n", "\t", "▁", "a", "the", "Tokens", "<s>", "<|endoftext|>", "<unk>", "é", "é", "\0",
            "\x1c", " ", "\xa0", "\x85", "日本", "😀", "ﬁ", "가", "Ж", "12", "'s", "!!", "...", ");", "}", "<0x41>", "﻿", "͸"]


@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    both = load(A, B)

    def tokens(text):
        """The libraries' own ids and token bytes of the whole text."""
        if not text:
            return [], []
        x, y, want = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
        sides = [[(i, table[i]) for i in ids] for ids, table in ((x, both.a_bytes), (y, both.b_bytes))]
        return sides if all(b"".join(t for _, t in s) == want for s in sides) else ([], [])

    return tokens


def brute(items, plain):
    """Contract rows from byte ranges: every pair of tokens is compared."""
    rows, held_by, per_doc = [], Counter(), []
    for text in items:
        spans = []
        for side in plain(text):
            at, own = 0, []
            for i, t in side:
                own.append((i, at, at + len(t)))
                at += len(t)
            spans.append(own)
        a, b = spans
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = [",".join(str(x[0]) for x in a if lo < x[2] <= hi) + "|" + ",".join(str(y[0]) for y in b if lo < y[2] <= hi)
                  for lo, hi in zip([0, *cuts], cuts)]
        per_doc.append(links)
        held_by.update(set(links))
        rows.append((len(a), len(b), len(groups), len(links), ";".join(groups)))
    best = defaultdict(int)
    for (x, _), n in held_by.items():
        best[x] = max(best[x], n)
    return [(*r[:4], sum(held_by[p] == best[p[0]] for p in links), sum(held_by[p] for p in links),
             hashlib.sha256(r[4].encode()).hexdigest() if r[4] else "") for r, links in zip(rows, per_doc)]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_ids_are_the_libraries(plain):
    texts = random_texts(4000, 1)
    for text, (x, y) in zip(texts, load(A, B).ids(texts)):
        want = [[i for i, _ in side] for side in plain(text)]
        assert [x.tolist(), y.tolist()] == want, repr(text)


def test_lanes_change_nothing():
    texts = [" ".join(random_texts(40, s)).replace("▁", "x") for s in range(5)] + ["", "x" * 3000, "a"]
    whole, cut = (Batch(texts, load(A, B), most) for most in (10**9, 3))
    for name in ("link_a", "link_b", "cut_a", "cut_b"):
        assert getattr(whole, name).tolist() == getattr(cut, name).tolist(), name
    assert whole.groups() == cut.groups()


def test_against_brute_force(spark, plain):
    items = random_texts(150, 2) + [None, "", "▁", "the a the a", "the a the a", " ", "\n", "word " * 700]
    rows = [(None if k == 3 else k // 2, t, "x") for k, t in enumerate(items)]  # ids twice, one null
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a string").withColumn("slab", F.lit(1)).repartition(3)
    got = sorted(map(str, map(tuple, align(df, A, B, slab=300).collect())))
    want = brute([t or "" for t in items], plain)
    assert got == sorted(str((r[0], *w)) for r, w in zip(rows, want))


def test_whole_alignments(spark, plain):
    items = ["the cat", None, "▁", "Zwei Wörter\nund mehr"]
    df = spark.createDataFrame([(k, t, 0) for k, t in enumerate(items)], "doc_id long, text string, groups int").repartition(2)
    for r in alignments(df, A, B).collect():
        assert [r.a_ids, r.b_ids] == [[i for i, _ in side] for side in plain(items[r.doc_id] or "")]
        digest = hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else ""
        assert digest == brute([items[r.doc_id] or ""], plain)[0][-1]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert align(df, A, B).collect() == [] and alignments(df, A, B).collect() == []
    one = align(spark.createDataFrame([(1, None)], "doc_id long, text string"), A, B).collect()
    assert [tuple(r) for r in one] == [(1, 0, 0, 0, 0, 0, 0, "")]
