"""Repeated byte strings across documents, from merged Burrows-Wheeler transforms.

A byte goes if a string of ``size`` bytes that covers it also starts in a document
with a smaller id.  The windows of ``size`` bytes are dealt to bins by their
smallest-hashed k-gram (the anchor): equal windows have equal anchors, so they meet.
Consecutive windows with one anchor travel as one segment.

Of the bytes of a window beside its anchor at least half lie on one side.  In a bin,
segments whose anchor with that many bytes before or after it occurs in one document
only cannot hold a repeat and are left out; equal segments are reduced to
one string with its smallest id.  The remaining strings form shards.  Each shard's
suffixes are sorted once; the shards' Burrows-Wheeler transforms are then merged by
interleave refinement: each pass prepends a byte to the intervals that hold suffixes
of several shards and so settles the order by one byte more, without sorting suffixes
again.  The pass in which an interval parts is the length of the common prefix; after
``size`` passes the intervals that are left are the strings that the shards share, and each
takes the smallest id of its members.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import materialize, quoted, release, table_bytes, texts

#: Bytes of an anchor.
ANCHOR = 12
#: Bytes of text whose segments are cut at once.
SLAB = 2 << 20

_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("stop", LongType())]))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hashes:
    """64-bit hashes of any substrings of ``data`` (wrapping arithmetic)."""

    _up = _down = np.zeros(0, np.uint64)

    def __init__(self, data: np.ndarray):
        if len(Hashes._up) <= len(data):
            Hashes._up = powers(_BASE, len(data) + (1 << 16))
            Hashes._down = powers(pow(_BASE, -1, 1 << 64), len(data) + (1 << 16))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * Hashes._up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        h = (self.sums[stops] - self.sums[starts]) * Hashes._down[starts]
        return h ^ (h >> np.uint64(29))

    def grams(self, k: int) -> np.ndarray:
        n = max(0, len(self.sums) - k)
        h = (self.sums[k:] - self.sums[:n]) * Hashes._down[:n]
        return h ^ (h >> np.uint64(29))


def leftmost_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value in each window of ``width`` values."""
    least, at, span = values, np.arange(len(values), dtype=np.int64), 1
    while span < width:
        step = min(span, width - span)
        n = max(0, len(least) - step)
        right = least[step:] < least[:n]
        least, at = np.where(right, least[step:], least[:n]), np.where(right, at[step:], at[:n])
        span += step
    return at


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of data[start : start + length]."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return data[:0]
    at = np.ones(ends[-1], np.int64)
    at[0] = starts[0]
    at[ends[:-1]] = starts[1:] - (starts[:-1] + lengths[:-1]) + 1
    return data[np.cumsum(at)]


def groups(keys: np.ndarray, kind: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(order, begins): a sort of ``keys`` (``kind`` "stable" keeps equal ones in order) and where each run of equal keys begins in it."""
    order = np.argsort(keys, kind=kind)
    s = keys[order]
    return order, np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, np.int64)


def numbers(order: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The group number of each element."""
    out = np.empty(len(order), np.int64)
    flags = np.zeros(len(order), np.int64)
    flags[begins[1:]] = 1
    out[order] = np.cumsum(flags)
    return out


# ---- cutting texts into segments -------------------------------------------------------------


def segments(docs: list[tuple[int, int, bytes]], size: int, bins: int):
    """(bin, payload) of the segments of some documents (id, checksum, text).

    Of equal segments among these documents only those of the smallest id are
    sent; the others are repeats for sure and are passed on as such.
    """
    data = np.frombuffer(b"".join(t for _, _, t in docs), np.uint8)
    lengths = np.array([len(t) for _, _, t in docs])
    stops = np.cumsum(lengths)
    if len(data) < size:
        return
    hashes = Hashes(data)
    grams = hashes.grams(ANCHOR)
    at = leftmost_smallest(grams, size - ANCHOR + 1)  # for each window start
    doc = np.repeat(np.arange(len(docs)), lengths)[: len(at)]
    inside = np.arange(len(at)) + size <= stops[doc]
    new = np.append(True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    keep = inside[first]
    first, last = first[keep], last[keep]
    if not len(first):
        return
    stop, owner, anchor = last + size, doc[first], at[first]
    ids, sums = np.array([d for d, _, _ in docs], np.int64), np.array([c for _, c, _ in docs], np.uint32)
    order, begins = groups(hashes.of(first, stop) ^ (stop - first).astype(np.uint64))
    least = np.repeat(np.minimum.reduceat(ids[owner][order], begins), np.diff(np.append(begins, len(order))))
    sent = np.empty(len(order), bool)
    sent[order] = ids[owner][order] == least
    bin_of = ((grams[anchor] >> np.uint64(11)) % np.uint64(bins)).astype(np.int64)
    origin = (stops - lengths)[owner]
    by_bin, starts = groups(bin_of, "stable")
    pack = zstandard.ZstdCompressor(level=3)
    for chosen in np.split(by_bin, starts[1:]):
        known, local = np.unique(owner[chosen], return_inverse=True)
        go = sent[chosen]
        some, rest = chosen[go], chosen[~go]
        payload = (np.diff(ids[known], prepend=0), sums[known], np.diff(local[go], prepend=0).astype(np.uint16 if len(known) < 65536 else np.uint32),
                   (first[some] - origin[some]).astype(np.uint32), (stop[some] - first[some]).astype(np.uint8 if 2 * size < 256 else np.uint32),
                   (anchor[some] - first[some]).astype(np.uint8 if size < 256 else np.uint32),
                   gather(data, first[some], stop[some] - first[some]),
                   local[~go].astype(np.uint32), (first[rest] - origin[rest]).astype(np.uint32), (stop[rest] - first[rest]).astype(np.uint32))
        yield int(bin_of[chosen[0]]), pack.compress(pickle.dumps(payload, protocol=5))


# ---- merging Burrows-Wheeler transforms ------------------------------------------------------

#: Symbols (9 bits each) that are compared at once before the passes begin.
HEAD = 7


class Shard:
    """One shard's suffixes in the order of their first ``depth`` symbols: ``order`` (their numbers),
    ``bwt`` (the symbol before each; 0 before a string's first), ``back`` (the place of the
    suffix that begins with that symbol), ``head`` (their first ``HEAD`` symbols) and
    ``begins`` (where the classes of equal first ``depth`` symbols begin)."""

    def __init__(self, order: np.ndarray, bwt: np.ndarray, head: np.ndarray, begins: np.ndarray):
        self.order, self.bwt, self.head, self.begins = order, bwt, head, begins
        self.back = np.empty(len(bwt), np.int32)  # a shard has far fewer than 2**31 symbols
        self.back[np.argsort(bwt, kind="stable")] = np.arange(len(bwt), dtype=np.int32)


def shard_of(symbols: np.ndarray, origin: int, depth: int) -> Shard:
    """Sort the suffixes of one shard once, by their first ``depth`` symbols (prefix doubling).

    ``symbols``: strings, each ended by 0.  Suffixes are numbered from ``origin``.
    """
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    left = np.repeat(ends, np.diff(np.append(-1, ends))) - np.arange(n)  # symbols before the end
    head, h = np.zeros(n, np.int64), min(HEAD, depth)
    for k in range(h):
        head <<= 9
        m = max(0, n - k)
        head[:m] |= np.where(left[:m] >= k, symbols[k:], 0)  # nothing after the end of a string
    order, begins = groups(head)
    rank = numbers(order, begins)
    while h < depth:
        step = min(h, depth - h)  # the last step reaches ``depth`` by overlapping
        further = np.zeros(n, np.int64)
        further[: max(0, n - step)] = rank[step:]
        further[left < step] = 0
        order, begins = groups(rank * (int(rank.max(initial=0)) + 1) + further)
        rank, h = numbers(order, begins), h + step
    before = np.append(np.uint16(0), symbols[:-1])  # a string begins after another's end
    return Shard(order + origin, before[order], head[order], begins)


def places(low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All places of the ranges [low, low + count)."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0, dtype=np.int32) + np.repeat((low - (ends - count)).astype(np.int32), count)


def shared_keys(keys: list[np.ndarray]) -> list[np.ndarray]:
    """Where each of the sorted lists holds the keys that at least two of them hold: a place
    for every such key, -1 where a list doesn't have it."""
    if len(keys) == 2 and all(map(len, keys)):
        at = np.minimum(np.searchsorted(keys[1], keys[0]), len(keys[1]) - 1)
        hit = np.flatnonzero(keys[1][at] == keys[0])
        return [hit, at[hit]]
    found, times = np.unique(np.concatenate(keys), return_counts=True)
    found, out = found[times > 1], []
    for own in keys:
        at = np.minimum(np.searchsorted(own, found), max(len(own) - 1, 0))
        out.append(np.where(own[at] == found, at, -1) if len(own) else np.full(len(found), -1))
    return out


def merge(shards: list[Shard], depth: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[np.ndarray]]:
    """Interleave the shards' Burrows-Wheeler transforms up to ``depth`` symbols.

    An interval of the interleaved order is a string; it lies at one range of places in every
    shard.  A pass prepends a symbol to all intervals: the suffixes of a range that a symbol
    stands before lie, one symbol longer, at one range again (``back``), so no suffix is
    sorted anew.  Only intervals with suffixes of several shards are refined: one that
    has those of a single shard is settled, its order is that shard's own.

    Returns (first places, counts) per shard of the intervals that are left after
    ``depth`` symbols, a row each, and per shard the length of the prefix that each
    suffix shares with one of another shard (``depth`` if it is that or more; less than ``HEAD`` counts as 0).
    """
    common = [np.zeros(len(s.bwt), np.int16 if depth < 1 << 15 else np.int64) for s in shards]
    at = min(HEAD, depth)
    found = []
    for s in shards:  # the interleave by the first symbols; strings that end there are left out
        begins = np.flatnonzero(np.append(True, s.head[1:] != s.head[:-1])) if len(s.head) else np.zeros(0, np.int64)
        counts = np.diff(begins, append=len(s.head))
        whole = (s.head[begins] & 511) != 0
        found.append((s.head[begins][whole], begins[whole], counts[whole]))
    while True:
        ranges = []
        for (_, low, count), of in zip(found, shared_keys([f[0] for f in found])):
            there = of >= 0
            ranges.append((np.where(there, low[of], 0), np.where(there, count[of], 0)) if len(low) else (np.zeros(len(of), np.int64),) * 2)
        live = len(ranges[0][0])
        inside = [places(low, count) for low, count in ranges]
        for c, p in zip(common, inside):
            c[p] = at
        if at == depth or not live:
            return ranges, common
        found = []
        for s, (_, count), p in zip(shards, ranges, inside):
            symbol, interval = s.bwt[p], np.repeat(np.arange(live, dtype=np.int32), count)
            order = np.argsort(symbol, kind="stable")
            order = order[len(symbol) - np.count_nonzero(symbol):]  # a string's first symbol has none before it
            keys = symbol[order] * np.int64(live) + interval[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
            found.append((keys[first], s.back[p[order[first]]], np.diff(first, append=len(keys))))
        at += 1


def smallest_ids(strings: list[np.ndarray], ids: np.ndarray, size: int, shards: int = 2) -> list[np.ndarray]:
    """For each string and each start of ``size`` bytes in it, the smallest id of a
    string that holds these bytes."""
    symbols, owner = [], []
    for part in np.array_split(np.arange(len(strings)), min(shards, len(strings))):
        symbols.append(np.concatenate([np.append(strings[i].astype(np.uint16) + 1, np.uint16(0)) for i in part]))
        owner.append(np.repeat(part, [len(strings[i]) + 1 for i in part]))
    starts = np.cumsum([0] + [len(s) for s in symbols])
    made = [shard_of(s, int(at), size) for s, at in zip(symbols, starts)]
    owner = np.concatenate(owner)
    lengths = np.array([len(s) for s in strings]) + 1
    base = np.cumsum(lengths) - lengths
    whole = np.arange(len(owner)) - base[owner] + size < lengths[owner]  # ``size`` bytes are left
    value = np.where(whole, ids[owner], np.iinfo(np.int64).max)
    least = [np.minimum.reduceat(value[s.order], s.begins) for s in made]  # of each shard's own classes
    if len(made) > 1:
        ranges, _ = merge(made, size)
        classes = [np.searchsorted(s.begins, low) for s, (low, _) in zip(made, ranges)]
        best = np.full(len(ranges[0][0]), np.iinfo(np.int64).max)
        for own, of, (_, count) in zip(least, classes, ranges):
            best = np.where(count > 0, np.minimum(best, own[of]), best)
        for own, of, (_, count) in zip(least, classes, ranges):
            own[of[count > 0]] = best[count > 0]
    smallest = np.empty(len(owner), np.int64)
    for s, own in zip(made, least):
        smallest[s.order] = np.repeat(own, np.diff(s.begins, append=len(s.order)))
    return [smallest[base[i] : base[i] + max(0, len(strings[i]) - size + 1)] for i in range(len(strings))]


# ---- one bin ---------------------------------------------------------------------------------


def solve_bin(payloads: list[bytes], size: int):
    """(id, checksum, start, stop) arrays of the removed runs found in one bin."""
    unpack = zstandard.ZstdDecompressor()
    parts, passed = [], []
    side = (size - ANCHOR) // 2
    for raw in payloads:
        steps, sums, local, start, length, anchor, data, l2, s2, n2 = pickle.loads(unpack.decompress(raw))
        ids, of, length = np.cumsum(steps), np.cumsum(local.astype(np.int64)), length.astype(np.int64)
        base = np.cumsum(length) - length
        hashes, at = Hashes(data), base + anchor
        parts.append((ids[of], sums[of], start.astype(np.int64), length, data, anchor >= side, length - anchor >= ANCHOR + side,
                      hashes.of(np.maximum(at - side, 0), at + ANCHOR), hashes.of(at, np.minimum(at + ANCHOR + side, len(data))),
                      hashes.of(base, base + length) ^ length.astype(np.uint64)))
        passed.append((ids[l2], sums[l2], s2.astype(np.int64), s2.astype(np.int64) + n2))
    ids, sums, start, length, data, more_left, more_right, left, right, whole = (np.concatenate(x) for x in zip(*parts))
    del parts
    base = np.cumsum(length) - length

    def shared(keys: np.ndarray, of: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Whether elements ``of`` with one key have different values."""
        out = np.zeros(len(keys), bool)
        k, v = keys[of], value[of]
        if len(k):
            order, begins = groups(k)
            sizes = np.diff(np.append(begins, len(k)))
            hit = np.empty(len(k), bool)
            hit[order] = np.repeat(np.minimum.reduceat(v[order], begins) != np.maximum.reduceat(v[order], begins), sizes)
            out[of] = hit
        return out

    lefts, rights = np.flatnonzero(more_left), np.flatnonzero(more_right)
    live = np.flatnonzero(shared(left, lefts, ids) | shared(right, rights, ids))
    # equal segments become one string
    order, begins = groups(whole[live])
    string = numbers(order, begins)
    example = live[order[begins]] if len(live) else live
    least = np.minimum.reduceat(ids[live][order], begins) if len(live) else ids[:0]
    # strings that share an anchor's surroundings with another string
    number = np.arange(len(example))
    ties = (shared(left[example], np.flatnonzero(more_left[example]), number)
            | shared(right[example], np.flatnonzero(more_right[example]), number))
    # smallest id for each window of each string
    windows = length[example] - size + 1
    ends = np.cumsum(windows)
    smallest = np.repeat(least, windows)
    tied = np.flatnonzero(ties)
    if len(tied):
        strings = [data[base[e] : base[e] + length[e]] for e in example[tied]]
        found = smallest_ids(strings, least[tied], size)
        smallest[gather(np.arange(len(smallest)), (ends - windows)[tied], windows[tied])] = np.concatenate(found)
    # windows of each segment that begin in a smaller id's text
    n = windows[string] if len(live) else windows
    which = gather(smallest, (ends - windows)[string], n) if len(live) else smallest
    segment = np.repeat(np.arange(len(live)), n)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    gone = which < ids[live][segment]
    segment, offset = segment[gone], offset[gone]
    new = np.flatnonzero(np.append(True, (segment[1:] != segment[:-1]) | (offset[1:] != offset[:-1] + 1))) if len(segment) else segment
    last = np.append(new[1:], len(segment)) - 1 if len(segment) else segment
    owner, begin = live[segment[new]], start[live[segment[new]]] + offset[new]
    stop = start[owner] + offset[last] + size
    return tuple(np.concatenate([x, *more]) for x, more in zip((ids[owner], sums[owner], begin, stop), zip(*passed)))


# ---- the operator ----------------------------------------------------------------------------


def merged_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching (start, stop) spans."""
    out: list[list[int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def remove_repeats(df: DataFrame, size: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   bin_bytes: int = 32 << 20) -> DataFrame:
    """(id, n_bytes, kept, spans) of every row: its UTF-8 bytes without the repeats
    (binary), and the removed runs (maximal, in order).

    Ids must be integers.  A byte goes if a string of ``size`` bytes covering it
    starts in a row with a smaller id; a null id is smaller than all others; rows
    with one id don't remove from each other, and repeated rows lose the same
    bytes.  Null texts are empty; texts shorter than ``size`` lose nothing; other
    columns are not read; an empty table gives an empty result.

    The repeats are written to the shared folder before the texts are cut, so a
    lost executor costs one of the two steps.  A bin gets about ``bin_bytes`` of
    segments at any scale.  Equal segments are
    reduced to their smallest id before they are shuffled, so a passage that a
    third of all documents share costs its bin one segment per slab of text.
    """
    if size < ANCHOR + 2:
        raise ValueError(f"size must be at least {ANCHOR + 2}")
    rows = df.select(quoted(id_col).alias("id"), F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("place", F.coalesce(F.col("id").cast("long"), F.lit(-(1 << 63))))
    expected = table_bytes(df, text_col) * (size - ANCHOR + size) // max(1, (size - ANCHOR) // 2)
    bins = max(1, -(-expected // bin_bytes))

    def cut(batches):
        for batch in batches:
            docs, held = [], 0
            for place, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                if len(text) >= size:
                    docs.append((place, zlib.crc32(text), text))
                    held += len(text)
                if held >= SLAB:
                    yield from packed(docs)
                    docs, held = [], 0
            if docs:
                yield from packed(docs)

    def packed(docs):
        made = list(segments(docs, size, bins))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in made], pa.int64()), pa.array([p for _, p in made], pa.binary())],
                                             names=["bin", "payload"])

    def solve(key, table):
        ids, sums, start, stop = solve_bin(table["payload"].to_pylist(), size)
        return pa.table({"place": pa.array(ids, pa.int64()), "sum": pa.array(sums.astype(np.int64)),
                         "start": pa.array(start, pa.int64()), "stop": pa.array(stop, pa.int64())})

    found = materialize(rows.select("place", "text").mapInArrow(cut, "bin long, payload binary").groupBy("bin")
                        .applyInArrow(solve, "place long, sum long, start long, stop long"), "repeats")
    release(df.sparkSession)  # the segments
    runs = found.groupBy("place", "sum").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))  # one document's own
    joined = rows.withColumn("sum", F.crc32(F.col("text").cast("binary"))).join(runs, ["place", "sum"], "left").select("id", "text", "spans")
    kind = rows.schema["id"].dataType

    def take(batches):
        for batch in batches:
            kept, spans, sizes = [], [], []
            for text, own in zip(texts(batch.column(1)), batch.column(2).to_pylist()):
                own = merged_spans(own)
                cuts = [0, *(x for s in own for x in s), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
                spans.append([{"start": a, "stop": b} for a, b in own])
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
                names=["id", "n_bytes", "kept", "spans"])

    schema = StructType([StructField("id", kind), StructField("n_bytes", LongType()), StructField("kept", BinaryType()),
                         StructField("spans", SPANS)])
    return joined.mapInArrow(take, schema).withColumnRenamed("id", id_col)
