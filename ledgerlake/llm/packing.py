"""Sum-of-squares online packing of token sequences into fixed windows.

``N(h)`` counts the open windows filled to level ``h``.  Each document's
remainder (its full windows are cut off first) goes to the level at which the
sum of the squared counts grows least: moving a window from ``h`` to ``h + s``
changes the sum by ``2 (N(h+s) - N(h)) + 2``, closing one (``h + s`` is the
capacity) by ``1 - 2 N(h)``, and opening one by ``2 N(s) + 1``.

Online packing is sequential, so documents are dealt by a seeded hash into
groups of a fixed number of bytes and each group has its own level array; when
a group ends, the windows still open are poured together (documents may be cut),
so that at most one window of a group is padded.
"""

from __future__ import annotations

import os
import sys
from array import array
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted, table_bytes, text_slices, texts
from .wordbpe import WordCache, byte_symbols, chunks, slices, split_tail

#: Latin letters in composed lower case: one word, which the BPE model alone can cut.
_PLAIN = frozenset(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))

PIECES = ("doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


class Ids:
    """Identifiers of whole texts as the ``tokenizers`` library gives them.

    Special strings aside, no token spans white space, so the library is asked
    once for each recent white-space separated chunk and its answers are joined.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.symbols = Tokenizer.from_file(path), byte_symbols()
        self.cut = self.tokenizer.model.tokenize
        self.cache = WordCache(self.chunk_ids)

    def encode(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit identifiers."""
        get = self.cache.__getitem__
        return b"".join(b"".join(map(get, chunks(part))) for part in slices(text))

    def chunk_ids(self, chunk: bytes) -> bytes:
        if chunk.isalpha() and chunk.islower():  # ASCII letters stand for themselves
            return array("I", [t.id for t in self.cut(chunk.decode())]).tobytes()
        if parts := split_tail(chunk):
            return self.cache[parts[0]] + self.cache[parts[1]]
        text = chunk.decode()
        if _PLAIN.issuperset(text):
            ids = [t.id for t in self.cut("".join(self.symbols[b] for b in chunk))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


assert array("I").itemsize == 4 and sys.byteorder == "little"  # identifiers are packed as little-endian 32-bit numbers


@lru_cache(maxsize=2)
def ids_of(path: str) -> Ids:
    """One tokenizer for each Python worker and file."""
    return Ids(path)


#: What a document counts in a group besides its text.
ROW_BYTES = 64


class SumOfSquares:
    """Places items of 1 to ``capacity - 1`` units into windows, online."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.level = np.zeros(capacity + 1, np.int64)  # level[h]: open windows filled to h
        self.open: dict[int, list[int]] = defaultdict(list)  # h: their numbers
        self.windows = 0

    def place(self, size: int) -> tuple[int, int]:
        """(window, offset) of an item; ties go to the fuller window, a new one last."""
        n, room = self.level, self.capacity - size
        filled = np.flatnonzero(n[1 : room + 1]) + 1
        best, at = 2 * int(n[size]) + 1, 0  # opening a window
        if len(filled):
            growth = 2 * (n[filled + size] - n[filled]) + np.where(filled == room, 1, 2)  # level[capacity] stays 0
            k = len(growth) - 1 - int(np.argmin(growth[::-1]))
            if growth[k] <= best:
                at = int(filled[k])
        if at:
            window = self.open[at].pop()
            n[at] -= 1
        else:
            window, self.windows = self.windows, self.windows + 1
        if at + size < self.capacity:
            self.open[at + size].append(window)
            n[at + size] += 1
        return window, at

    def still_open(self) -> list[int]:
        return [w for h in sorted(self.open, reverse=True) for w in self.open[h]]


def pack(lengths: list[int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(item, start, length, window, offset) of every piece; windows are numbered from 0."""
    packer, full, placed = SumOfSquares(capacity), [], defaultdict(list)
    for item, total in enumerate(lengths):
        whole = total // capacity * capacity
        full += [(item, start) for start in range(0, whole, capacity)]
        if total > whole:
            window, offset = packer.place(total - whole)
            placed[window].append((item, whole, total - whole, offset))
    out, left = [], packer.still_open()
    for window in sorted(placed.keys() - set(left)):
        out += [(item, start, length, window, offset) for item, start, length, offset in placed[window]]
    number = packer.windows
    for item, start in full:
        out.append((item, start, capacity, number, 0))
        number += 1
    at = 0  # pour what is still open into one run of windows, cutting where a window ends
    for item, start, length, _ in (p for w in left for p in placed[w]):
        while length:
            take = min(length, capacity - at)
            out.append((item, start, take, number, at))
            start, length, at = start + take, length - take, at + take
            if at == capacity:
                number, at = number + 1, 0
    return out


def pack_documents(df: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, group_bytes: int = 8 << 20,
                   seed: int = 5, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Pieces of all documents packed into sequences of ``capacity`` tokens.

    One row per piece: doc_id, start (the document's ids before it), length, ids
    (binary, little-endian unsigned 32-bit), doc_tokens (with ``end_id``, which
    closes every document), sequence_id, offset (within the sequence).  Each id
    lies in exactly one piece.  A null or empty text is one ``end_id``; a null id
    is kept as null; repeated rows are packed one by one; other columns are not
    read.  An empty table gives no pieces.

    Texts are tokenized where they are read and only ids are shuffled.  Groups
    are dealt by a hash of the document and its place in the input (which must
    be a stable scan), so a document repeated any number of times is spread over
    all groups; a group holds about ``group_bytes`` at any scale (a document
    counts its text and a fixed cost), and a document longer than that is one
    (larger) group member.
    """
    kind = df.select(quoted(id_col)).schema[0].dataType.simpleString()
    groups = max(1, -(-table_bytes(df, text_col, per_row=ROW_BYTES) // group_bytes))
    rows = df.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("string").alias("text"),
                     F.monotonically_increasing_id().alias("place"))
    close = np.array([end_id], "<u4").tobytes()

    def tokenize(batches):
        own = ids_of(tokenizer)
        for batch in (part for whole in batches for part in text_slices(whole, 1)):
            found = [own.encode(t) + close for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), batch.column(2)],
                                             names=["doc_id", "ids", "place"])

    deal = F.xxhash64(F.lit(seed), F.col("place"), F.col("doc_id"))
    tokens = (rows.mapInArrow(tokenize, f"doc_id {kind}, ids binary, place long")
              .withColumn("turn", deal).withColumn("part", F.pmod("turn", F.lit(groups))))

    def pack_group(key, table):
        table = table.sort_by([("turn", "ascending"), ("place", "ascending")])
        ids = table["ids"].to_pylist()
        pieces = pack([len(x) // 4 for x in ids], capacity)
        base = int(key[0].as_py()) << 32
        return pa.table({
            "doc_id": table["doc_id"].take(pa.array([p[0] for p in pieces], pa.int64())),
            "start": pa.array([p[1] for p in pieces], pa.int64()), "length": pa.array([p[2] for p in pieces], pa.int64()),
            "ids": pa.array([ids[i][4 * s : 4 * (s + n)] for i, s, n, _, _ in pieces], pa.binary()),
            "doc_tokens": pa.array([len(ids[p[0]]) // 4 for p in pieces], pa.int64()),
            "sequence_id": pa.array([base + p[3] for p in pieces], pa.int64()),
            "offset": pa.array([p[4] for p in pieces], pa.int64())})

    return (tokens.select("part", "turn", "place", "doc_id", "ids").groupBy("part")
            .applyInArrow(pack_group, PIECES.format(kind=kind)).withColumnRenamed("doc_id", id_col))
