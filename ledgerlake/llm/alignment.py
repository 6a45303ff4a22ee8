"""Cross-tokenizer alignment by lockstep vectorised merging.

Two tokenizers cut the same bytes differently.  A text's tokens of A and B are
walked together: a pointer into each list, a link for the pair they stand on, and
the pointer whose token ends first moves on (both, if the ends are equal, which is
a cut).  One NumPy state vector holds the pointers of all documents of a batch and
all of them step at once; documents that are finished leave the vector.  A long
document is walked as several lanes that begin at ends which A and B share, so one
long text does not keep the whole batch stepping.

The corpus side counts in how many documents each linked id pair occurs.  Every
batch (slab) keeps its own dictionary of pairs, so a pair that stands in every
document travels once per slab, not once per document.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from .common import materialize, quoted, texts

#: Bytes of text that are aligned as one batch.
SLAB = 1 << 20
#: Tokens of A after which a document goes on in another lane.
LANE = 1024
#: Chunks of text, and their characters, beyond which a task forgets the ids it keeps.
KEPT_CHUNKS, KEPT_BYTES = 150_000, 8 << 20
#: Unknown chunks that are cut in one call.
RUN = 64

#: Chunks end before a space or line feed that follows no white space: A has no token across
#: that place, and B none unless a piece holds a line feed behind another character
#: (``Tokenizers.breaks``).  Other white space ends no chunk: piece models have pieces across it.
CHUNK, BREAK, OTHER_SPACE = re.compile(r"\s+\S*"), re.compile(r"(?<=\S)(?=[ \n])"), re.compile(r"[^\S \n]")
#: The pattern of byte-level vocabularies (a fixed value), and letters on which libraries may differ.
BYTE_LEVEL = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BEYOND_LATIN = re.compile("[^\x00-\u024f]")
#: What a row counts in a slab besides its text.
ROW_BYTES = 64


def byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable
    Latin-1 symbols stand for themselves, the others are numbered from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers of a task, with the ids of chunks met before."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=b_path)
        symbols = byte_of_symbol()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            known = all(s in symbols for s in entry)
            self.a_bytes[i] = bytes(symbols[s] for s in entry) if known else entry.encode()
        self.b_bytes = [self.piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.vocab_size())]
        self.space_id = self.b.piece_to_id("▁")
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        #: B's pieces hold spaces and line feeds only at their start, so chunks can be cut apart.
        self.breaks = not any(b" " in x.lstrip(b" ") or b"\n" in x[1:] for x in self.b_bytes)
        self.ranked = self.ranks(a_path)
        #: Ids of chunks as unsigned 32-bit numbers.
        self.kept_a: dict[str, bytes] = {}
        self.kept_b: dict[str, bytes] = {}
        self.lossy: set[str] = set()
        self.kept_bytes = 0
        #: An id with the separator behind it, at id * 4 + 0 (","), 1 ("|") or 2 (";").
        self.shown = [f"{i}{mark}" for i in range(max(len(self.a_bytes), len(self.b_bytes))) for mark in (",", "|", ";", "")]

    @staticmethod
    def piece_bytes(piece: str) -> bytes:
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def ranks(self, a_path: str):
        """A's vocabulary as ranks for the faster library; None unless its ids are in merge order
        and nothing but the byte-level pattern comes before the merges."""
        with open(a_path, encoding="utf-8") as f:
            whole = json.load(f)
        model, before = whole["model"], whole.get("pre_tokenizer") or {}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model.get("merges", [])]
        plain = (model.get("type", "BPE") == "BPE" and not whole.get("normalizer") and before.get("type") == "ByteLevel"
                 and not before.get("add_prefix_space") and before.get("use_regex", True) and not model.get("ignore_merges"))
        if not plain or merged != sorted(set(merged)):
            return None
        import tiktoken

        special = {t["id"] for t in whole.get("added_tokens", [])}
        return tiktoken.Encoding("a", pat_str=BYTE_LEVEL, special_tokens={},
                                 mergeable_ranks={x: i for i, x in enumerate(self.a_bytes) if x and i not in special})

    def whole(self, chunk: str) -> tuple[list[int], list[int]]:
        """Ids of ``chunk``; a space at its start is the one that B adds by itself."""
        a = self.a.encode(chunk, add_special_tokens=False).ids
        return a, self.b_ids(chunk)

    def b_ids(self, chunk: str) -> list[int]:
        if chunk[0] == " ":
            return self.b.encode(chunk[1:]) if len(chunk) > 1 else [self.space_id]
        return self.b.encode(chunk)[1:]  # no piece joins the added space to other white space

    def same(self, a: list[int], b: list[int], want: bytes) -> bool:
        return b"".join(map(self.a_bytes.__getitem__, a)) == want == b"".join(map(self.b_bytes.__getitem__, b))

    def learn(self, chunks: set[str]) -> None:
        """Keep the ids of all ``chunks``; those whose tokens do not join to their bytes go to ``lossy``."""
        if len(self.kept_a) > KEPT_CHUNKS or self.kept_bytes > KEPT_BYTES:
            self.kept_a.clear()
            self.kept_b.clear()
            self.lossy.clear()
            self.kept_bytes = 0
        new = chunks.difference(self.kept_a)
        self.kept_bytes += sum(map(len, new))
        easy = [c for c in new if not c[-1].isspace()] if self.ranked else []
        if BEYOND_LATIN.search("".join(easy)):
            easy = [c for c in easy if not BEYOND_LATIN.search(c)]
        a, b = [], []
        for k in range(0, len(easy), RUN):
            text = "".join(easy[k : k + RUN])
            a += self.ranked.encode_ordinary(text)
            b += self.b_ids(text)
        if self.same(a, b, "".join(easy).encode()):
            ends = np.cumsum([len(c.encode()) for c in easy])
            for kept, ids, size in ((self.kept_a, a, self.a_size), (self.kept_b, b, self.b_size)):
                packed = np.array(ids, np.uint32).tobytes()
                cut = ((np.searchsorted(np.cumsum(size[ids]), ends) + 1) * 4).tolist() if easy else []
                kept.update(zip(easy, [packed[x:y] for x, y in zip([0, *cut], cut)]))
        for c in new.difference(self.kept_a):
            a, b = self.whole(c)
            self.kept_a[c], self.kept_b[c] = (np.array(x, np.uint32).tobytes() for x in (a, b))
            if not self.same(a, b, c.encode()):
                self.lossy.add(c)

    def chunks(self, spaced: str) -> list[str]:
        if not self.breaks:
            return [spaced]
        return BREAK.split(spaced) if OTHER_SPACE.search(spaced) else CHUNK.findall(spaced)

    def ids(self, items: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """A's and B's ids of each text; none if it is empty or either joins to other bytes than space + text."""
        cut = [self.chunks(" " + t) if t else [] for t in items]
        self.learn(set().union(*cut))
        known = self.kept_a.__getitem__, self.kept_b.__getitem__
        out = []
        for text, chunks in zip(items, cut):
            if self.lossy and not self.lossy.isdisjoint(chunks):  # the text as a whole decides
                a, b = self.whole(" " + text)
                fits = self.same(a, b, (" " + text).encode())
                out.append(tuple(np.array(x if fits else [], np.uint32) for x in (a, b)))
            else:
                out.append(tuple(np.frombuffer(b"".join(map(k, chunks)), np.uint32) for k in known))
        return out


def lanes(a_end: np.ndarray, b_end: np.ndarray, a_from: np.ndarray, b_from: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First tokens (of A, of B) of all lanes: the documents' own starts, and in documents of
    over ``most`` A tokens shared ends about every ``most`` tokens.  ``a_from`` / ``b_from``
    hold each document's first token, and the totals at the end."""
    a, b = [a_from[:-1]], [b_from[:-1]]
    for d in np.flatnonzero(np.diff(a_from) > most):
        own_a, own_b = a_end[a_from[d] : a_from[d + 1]], b_end[b_from[d] : b_from[d + 1]]
        at, size = most, len(own_a)
        while at < size:
            width = 64
            while True:  # the next end of A, from ``at`` on, that B shares; the document's own end always is one
                ends = own_a[at : at + width]
                place = np.searchsorted(own_b, ends)
                shared = np.flatnonzero(own_b[place] == ends)
                if len(shared):
                    break
                width *= 4
            at += int(shared[0]) + 1
            if at < size:
                a.append(np.array([a_from[d] + at]))
                b.append(np.array([b_from[d] + int(place[shared[0]]) + 1]))
            at += most - 1
    return np.sort(np.concatenate(a)), np.sort(np.concatenate(b))


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_from: np.ndarray, b_from: np.ndarray,
             most: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) and cuts (last A token, last B token) of a batch, each in order.

    ``a_end`` / ``b_end`` are the byte ends of all tokens inside their document.
    Every lane has as many A as B bytes and at least one token of each.
    """
    full = np.diff(a_from) > 0
    if not full.any():
        return (np.empty(0, np.int64),) * 4
    a_from, b_from = (np.append(f[:-1][full], f[-1]) for f in (a_from, b_from))
    i, j = lanes(a_end, b_end, a_from, b_from, most)
    stop = np.append(i[1:], len(a_end))
    link_a, link_b, cut_a, cut_b = [], [], [], []
    while len(i):
        link_a.append(i)
        link_b.append(j)
        x, y = a_end[i], b_end[j]
        even = x == y
        cut_a.append(i[even])
        cut_b.append(j[even])
        i, j = i + (x <= y), j + (y <= x)
        done = i == stop
        if done.any():  # a lane ends at a cut, so B's pointer is through as well
            left = ~done
            i, j, stop = i[left], j[left], stop[left]
    link_a, link_b = np.concatenate(link_a), np.concatenate(link_b)
    order = np.argsort(link_a + link_b, kind="stable")  # each step inside a document raises the sum by 1 or 2
    return link_a[order], link_b[order], np.sort(np.concatenate(cut_a)), np.sort(np.concatenate(cut_b))


class Batch:
    """The alignment of the texts of one slab."""

    def __init__(self, items: list[str], tokenizers: Tokenizers, most: int = LANE):
        ids = tokenizers.ids(items)
        self.n, self.tokenizers = len(items), tokenizers
        self.a, self.b = (np.concatenate([np.empty(0, np.int64), *(x[k] for x in ids)]).astype(np.int64) for k in (0, 1))
        self.a_from, self.b_from = (np.cumsum([0, *(len(x[k]) for x in ids)]) for k in (0, 1))
        self.doc_of_a = np.repeat(np.arange(self.n), np.diff(self.a_from))
        ends = [self.ends(x, size, at) for x, size, at in ((self.a, tokenizers.a_size, self.a_from), (self.b, tokenizers.b_size, self.b_from))]
        self.link_a, self.link_b, self.cut_a, self.cut_b = lockstep(*ends, self.a_from, self.b_from, most)

    @staticmethod
    def ends(ids: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(sizes[ids])])
        return total[1:] - np.repeat(total[at[:-1]], np.diff(at))

    def per_document(self, docs: np.ndarray) -> np.ndarray:
        return np.bincount(docs, minlength=self.n)

    def groups(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each document: the ids between cuts."""
        a_group = np.concatenate([[0], np.cumsum(np.bincount(self.cut_a, minlength=len(self.a)))])[:-1] if len(self.a) else self.a
        b_group = np.concatenate([[0], np.cumsum(np.bincount(self.cut_b, minlength=len(self.b)))])[:-1] if len(self.b) else self.b
        b_before = np.concatenate([[0], self.cut_b + 1])  # B tokens before each group
        out = np.empty(len(self.a) + len(self.b), np.int64)  # id * 4 + separator behind it: 1 is |, 2 is ;
        code_a, code_b = self.a * 4, self.b * 4
        code_a[self.cut_a] += 1
        code_b[self.cut_b] += 2
        out[np.arange(len(self.a)) + b_before[a_group]] = code_a
        out[np.arange(len(self.b)) + self.cut_a[b_group] + 1] = code_b
        parts, at = list(map(self.tokenizers.shown.__getitem__, out.tolist())), (self.a_from + self.b_from).tolist()
        return ["".join(parts[x:y])[:-1] for x, y in zip(at, at[1:])]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(pair, its documents, document of each entry, links of each entry): entries by pair, then document."""
        wide, docs = len(self.tokenizers.b_bytes), max(self.n, 1)
        key = (self.a[self.link_a] * wide + self.b[self.link_b]) * docs + self.doc_of_a[self.link_a]
        key, links = np.unique(key, return_counts=True)
        pair, doc = np.divmod(key, docs)
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        known = pair[first]
        return known // wide << 32 | known % wide, np.diff(first, append=len(pair)), doc, links


def slabs(batches: Iterator[pa.RecordBatch], text_at: int, slab: int) -> Iterator[tuple[pa.Table, list[str]]]:
    """Rows of a task in runs of about ``slab`` bytes of text."""
    parts, items, size = [], [], 0
    for batch in batches:
        first = 0
        for k, text in enumerate(texts(batch.column(text_at))):
            items.append(text.decode())
            size += len(text) + ROW_BYTES
            if size >= slab:
                parts.append(batch.slice(first, k + 1 - first))
                yield pa.Table.from_batches(parts), items
                parts, items, size, first = [], [], 0, k + 1
        if first < batch.num_rows:
            parts.append(batch.slice(first))
    if parts:
        yield pa.Table.from_batches(parts), items


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def load(a_path: str, b_path: str) -> Tokenizers:
    """The tokenizers of this worker process."""
    if (a_path, b_path) not in _LOADED:
        _LOADED.clear()
        _LOADED[a_path, b_path] = Tokenizers(a_path, b_path)
    return _LOADED[a_path, b_path]


def alignments(df: DataFrame, a_path: str, b_path: str, text_col: str = "text", slab: int = SLAB) -> DataFrame:
    """All columns of ``df`` plus the alignment itself: ``a_ids``, ``b_ids`` and the text
    ``groups`` (ids between shared token ends, ``a1,a2|b1;a3|b2,b3``).

    Null, empty and lossy texts (see ``align``) have empty lists and an empty text.
    A column of ``df`` with one of the names is replaced.  No shuffle.
    """
    added = ("a_ids", "b_ids", "groups")
    names = [c for c in df.columns if c.lower() not in added]
    rows = df.select(*map(quoted, names))
    at = next(k for k, c in enumerate(names) if c.lower() == text_col.lower())

    def run(batches):
        for table, items in slabs(batches, at, slab):
            found = Batch(items, load(a_path, b_path))
            lists = [pa.ListArray.from_arrays(pa.array(x, pa.int32()), pa.array(y, pa.int64()))
                     for x, y in ((f, v) for f, v in ((found.a_from, found.a), (found.b_from, found.b)))]
            columns = [*table.combine_chunks().columns, *lists, pa.array(found.groups(), pa.string())]
            yield from pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns],
                                            names=[*names, *added]).to_batches()

    schema = StructType([*rows.schema.fields, StructField("a_ids", ArrayType(LongType())),
                         StructField("b_ids", ArrayType(LongType())), StructField("groups", StringType())])
    return rows.mapInArrow(run, schema)


NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", slab: int = SLAB) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    Tokens of A (a byte-level vocabulary, over space + text) and of B (a piece model,
    which adds that space) are linked where their byte ranges overlap; groups lie
    between ends that both share.  A pair's count is the number of rows that hold it
    linked; ``n_best`` counts links whose count is the highest of their A id (ties
    included), ``count_sum`` adds the counts up over the links.

    A null or empty text, and one whose tokens of either side do not join to space +
    text, has no tokens: zeros and an empty ``groups_sha256``.  A text of any length
    is aligned whole, in lanes.  Repeated rows and ids are rows of their own, a null
    id stays null, other columns are not read, an empty table gives an empty result.

    Two passes over written tables: slabs of ``slab`` bytes of text are aligned where
    they are read and written with their dictionary of pairs; the dictionaries are
    summed over the corpus, and each slab is joined with the sums of its own pairs.
    Nothing is broadcast, and a pair has one row per slab at most.
    """
    spark = df.sparkSession
    rows = df.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType

    def run(batches):
        task = TaskContext.get().partitionId() << 32
        for k, (table, items) in enumerate(slabs(batches, 1, slab)):
            found = Batch(items, load(a_path, b_path))
            known, held_by, doc, links = found.pairs()
            numbers = [np.diff(found.a_from), np.diff(found.b_from), found.per_document(found.doc_of_a[found.cut_a]),
                       found.per_document(found.doc_of_a[found.link_a])]
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups()]
            ids = table.column(0).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [pa.array([task + k], pa.int64()), one_list(ids), *(one_list(pa.array(x, pa.int64())) for x in numbers),
                 one_list(pa.array(digests, pa.string())), one_list(pa.array(known, pa.int64())), one_list(pa.array(held_by, pa.int64())),
                 *(pa.array([x.astype(np.uint32).tobytes()], pa.binary()) for x in (doc, links))],
                names=[f.name for f in slab_schema.fields])

    def listed(name, of):
        return StructField(name, ArrayType(of))

    slab_schema = StructType([
        StructField("slab", LongType()), listed("ids", kind), *(listed(n, LongType()) for n in NUMBERS), listed("groups_sha256", StringType()),
        listed("pairs", LongType()), listed("held_by", LongType()), StructField("docs", BinaryType()), StructField("links", BinaryType())])
    aligned = materialize(rows.mapInArrow(run, slab_schema), "aligned-slabs")

    own = aligned.select("slab", F.explode(F.arrays_zip("pairs", "held_by")).alias("p")).select("slab", "p.pairs", "p.held_by")
    counts = materialize(own.groupBy("pairs").agg(F.sum("held_by").alias("count")), "pair-counts")
    best = counts.groupBy(F.shiftright("pairs", 32).alias("a")).agg(F.max("count").alias("best"))
    judged = (counts.withColumn("a", F.shiftright("pairs", 32)).join(best, "a")
              .select("pairs", "count", (F.col("count") == F.col("best")).alias("is_best")))
    answers = (own.select("slab", "pairs").join(judged, "pairs").groupBy("slab")
               .agg(F.sort_array(F.collect_list(F.struct("pairs", "count", "is_best"))).alias("found"))
               .select("slab", F.col("found.count").alias("counts"), F.col("found.is_best").alias("is_best")))
    met = (aligned.join(answers, "slab", "left")
           .select("ids", *NUMBERS, "groups_sha256", "held_by", "docs", "links", "counts", "is_best"))

    def score(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = dict(zip(batch.schema.names, batch.slice(k, 1).columns))
                ids = row["ids"].flatten()
                held_by = row["held_by"].flatten().to_numpy().astype(np.int64)
                doc, links = (np.frombuffer(row[c][0].as_py(), np.uint32).astype(np.int64) for c in ("docs", "links"))
                n_best, count_sum = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
                if len(doc):
                    count = row["counts"].flatten().to_numpy()
                    is_best = row["is_best"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                    np.add.at(n_best, doc, links * np.repeat(is_best, held_by))
                    np.add.at(count_sum, doc, links * np.repeat(count, held_by))
                yield pa.RecordBatch.from_arrays(
                    [ids, *(row[n].flatten() for n in NUMBERS), pa.array(n_best), pa.array(count_sum), row["groups_sha256"].flatten()],
                    names=[f.name for f in out_schema.fields])

    out_schema = StructType([StructField(id_col, kind), *(StructField(n, LongType()) for n in (*NUMBERS, "n_best", "count_sum")),
                             StructField("groups_sha256", StringType())])
    return met.mapInArrow(score, out_schema)


def one_list(values: pa.Array) -> pa.ListArray:
    """One row that holds all ``values`` as its list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
