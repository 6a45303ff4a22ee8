"""Token counts and packing against the tokenizers library."""

import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm.packing import Ids, SumOfSquares, pack, pack_documents
from ledgerlake.llm.wordbpe import WordCounter, count_tokens, slices

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n\t ", "a", "Hello, WORLD!! it's we'll they've I'd don'T", "<|endoftext|>", "x<|startoftext|>y <|EndOfText|> <|",
       "éÉ é ΑΣ ΣΑΣ İi ß ẞ ﬁ Å 漢字かな 123٣४ 🙂👍🏽 ​ 　x\x1cy\x85z", "a" * 3000, "ñ." * 700, "...,,,!!!", "foo.bar,baz '.'"]

LAST = 0x20000  # the planes in use for text and emoji


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text, add_special_tokens=False).ids


def cases():
    rng = random.Random(3)
    alphabet = "abcdeéñßABZ 09.,!?'\n<|>_-ſıΣ中ー́̀"
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(400)]


def test_counts_and_ids_equal_the_library(library):
    import numpy as np
    counter, ids = WordCounter(PATH), Ids(PATH)
    for text in cases():
        want = library(text)
        assert counter.count(text.encode()) == len(want), repr(text)
        assert np.frombuffer(ids.encode(text.encode()), "<u4").tolist() == want, repr(text)


def test_every_character(library):
    counter = WordCounter(PATH)
    wrong = []
    for start in range(1, LAST, 512):
        text = " ".join(f"a{chr(c)}b" for c in range(start, min(start + 512, LAST)) if not 0xD800 <= c < 0xE000)
        if text and counter.count(text.encode()) != len(library(text)):
            wrong.append(hex(start))
    assert not wrong


def test_slices_cut_only_at_white_space():
    text = b"abc def\nghi " * 50 + b"x" * 100 + b" end"
    parts = list(slices(text, 40))
    assert b"".join(parts) == text and all(p[:1] in b" \n" for p in parts[1:])


def table(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (5, None), (3, "a"), (3, "a"), (99, "word " * 9000)]
    return (spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
            .withColumn("key", F.lit(1)).withColumn("part", F.lit(2)).withColumn("ids", F.lit(3))), rows


def test_count_tokens(spark, library):
    df, rows = table(spark)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(df, PATH).collect())
    want = sorted((i if i is not None else -1, len((t or "").encode()), n := len(library(t or "")), n > 2048) for i, t in rows)
    assert got == want
    assert count_tokens(df.limit(0), PATH).count() == 0


def check_pieces(pieces, docs, library, capacity):
    """Each document's pieces tile it; each sequence's pieces tile a prefix of the window."""
    by_seq, by_doc = {}, {}
    for p in pieces:
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_doc.setdefault(p.doc_id, []).append(p)
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    for doc, text in docs.items():
        want = library(text or "") + [2]
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(want)
            raw = b"".join(i.to_bytes(4, "little") for i in want[at : at + p.length])
            assert bytes(p.ids) == raw and zlib.crc32(raw) == zlib.crc32(bytes(p.ids))
            at += p.length
        assert at == len(want)
    return sum(p.length for p in pieces), len(by_seq)


def test_pack_documents(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(-1, None), (99, "word " * 9000), (100, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    for group_bytes in (1 << 20, 500):
        pieces = pack_documents(df, PATH, capacity=64, group_bytes=group_bytes).collect()
        tokens, windows = check_pieces(pieces, dict(rows), library, 64)
        if group_bytes > 1000:
            assert windows == -(-tokens // 64)  # one group: at most its last window is padded
    assert pack_documents(df.limit(0), PATH).count() == 0


def test_repeated_and_null_ids_are_packed_one_by_one(spark, library):
    df = spark.createDataFrame([(7, "same text")] * 50 + [(None, "x")], "doc_id long, text string")
    pieces = pack_documents(df, PATH, capacity=16).collect()
    assert sum(p.length for p in pieces) == 50 * (len(library("same text")) + 1) + len(library("x")) + 1
    assert {p.doc_id for p in pieces} == {7, None}


def test_sum_of_squares_choice_is_minimal():
    rng = random.Random(1)
    packer = SumOfSquares(12)
    for _ in range(500):
        size = rng.randrange(1, 12)
        before = packer.level.copy()

        def cost(h):
            n = before.copy()
            if h:
                n[h] -= 1
            if h + size < 12:
                n[h + size] += 1
            return int((n[1:12] ** 2).sum())

        options = [0] + [h for h in range(1, 13 - size) if before[h]]
        packer.place(size)
        assert int((packer.level[1:12] ** 2).sum()) == min(map(cost, options))


def test_pack_long_items():
    pieces = pack([10, 4096, 9000, 1], 4096)
    assert sum(p[2] for p in pieces) == 13107 and len({p[3] for p in pieces}) == 4
