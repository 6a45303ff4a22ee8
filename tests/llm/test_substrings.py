"""Repeated byte strings against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import substrings
from ledgerlake.llm.substrings import merge, remove_repeats, shard_of, smallest_ids


def brute(rows, size):
    """(id, bytes, kept, spans) of every row."""
    lowest = -(1 << 63)
    texts = [(lowest if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        for p in range(len(t) - size + 1):
            first[t[p : p + size]] = min(i, first.get(t[p : p + size], i))
    out = []
    for (own, _), (i, t) in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - size + 1):
            if first[t[p : p + size]] < i:
                gone[p : p + size] = True
        edges = np.flatnonzero(np.diff(np.append(False, gone)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((own, len(t), bytes(b for k, b in enumerate(t) if not gone[k]), spans))
    return sorted(out, key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "über", "naïve", "and", "x", "aaaa", "running", "日本", "\n", "stone", "be"]
    text = lambda k: " ".join(rng.choice(vocabulary) + (str(rng.randrange(40)) if rng.random() < 0.4 else "") for _ in range(k))
    passages = [text(rng.randrange(6, 40)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [text(rng.randrange(0, 30))]
        for _ in range(rng.randrange(0, 3)):
            parts += [rng.choice(passages), text(rng.randrange(0, 12))]
        rows.append((i * 3 % n, "".join(parts)))
    rows += [(i + n, rows[i][1]) for i in range(10)] + [(200, rows[3][1][:-4] + "?" + rows[3][1][-3:])]
    rows += [(201, "ab" * 200), (202, "ab" * 150), (203, "a" * 49), (204, "a" * 300), (205, "a" * 50), (206, "\x00" * 120), (207, "\x00" * 60)]
    return rows


@pytest.mark.parametrize("size", [50, 30])
def test_against_brute_force(spark, size, monkeypatch):
    monkeypatch.setattr(substrings, "SLAB", 3000)
    rows = corpus(size) + [(None, corpus(size)[0][1]), (300, None), (301, ""), (5, "other text under a known id " * 5), (302, "q" * 60), (302, "q" * 60)]
    df = (spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("place", F.lit("clash"))
          .withColumn("spans", F.lit("clash")).withColumn("id", F.lit(1)))
    got = sorted(((r.doc_id, r.n_bytes, bytes(r.kept), [(s.start, s.stop) for s in r.spans])
                  for r in remove_repeats(df, size, bin_bytes=20_000).collect()), key=repr)
    assert got == brute(rows, size)
    assert any(r[3] for r in got)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def suffixes_of(symbols):
    """Each suffix up to and with the end of its string."""
    ends = [i for i, c in enumerate(symbols) if c == 0]
    return [tuple(symbols[p : next(e for e in ends if e >= p) + 1]) for p in range(len(symbols))]


def prefix_shared(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n] != 0:
        n += 1
    return n


@pytest.mark.parametrize("count,depth", [(2, 6), (2, 12), (3, 9), (4, 20)])
def test_merge_settles_intervals_and_common_prefixes(count, depth):
    rng = random.Random(count * depth)
    for _ in range(12):
        parts = [np.array(sum(([rng.randrange(1, 3) for _ in range(rng.randrange(1, 25))] + [0] for _ in range(rng.randrange(1, 6))), []), np.uint16)
                 for _ in range(count)]
        shards = [shard_of(p, 0, depth) for p in parts]
        suffixes = [suffixes_of(p.tolist()) for p in parts]
        for s, own in zip(shards, suffixes):  # sorted, classes of equal first symbols
            ordered = [own[p][:depth] for p in s.order]
            assert ordered == sorted(ordered)
            assert s.begins.tolist() == [k for k in range(len(ordered)) if not k or ordered[k] != ordered[k - 1]]
        ranges, common = merge(shards, depth)
        intervals = {}
        for k in range(len(ranges[0][0])):
            strings = {suffixes[j][p][:depth] for j, (low, n) in enumerate(ranges) for p in shards[j].order[low[k] : low[k] + n[k]]}
            assert len(strings) == 1
            intervals[strings.pop()] = [int(n[k]) for _, n in ranges]
        want = {}
        for j, own in enumerate(suffixes):
            for x in own:
                if len(x) > depth:
                    want.setdefault(x[:depth], [0] * count)[j] += 1
        assert intervals == {x: n for x, n in want.items() if sum(c > 0 for c in n) > 1}
        for j, (s, own) in enumerate(zip(shards, suffixes)):
            for p, length in zip(s.order, common[j]):
                best = min(depth, max(prefix_shared(own[p], x) for i, other in enumerate(suffixes) if i != j for x in other))
                assert length == (best if best >= min(substrings.HEAD, depth) else 0)


@pytest.mark.parametrize("shards", [1, 2, 3, 5])
def test_smallest_ids(shards):
    rng = random.Random(shards)
    strings = [np.array([rng.randrange(0, 3) for _ in range(rng.randrange(4, 30))], np.uint8) for _ in range(25)]
    ids = np.array([rng.randrange(1000) for _ in strings])
    want = {}
    for s, i in zip(strings, ids):
        for p in range(len(s) - 4):
            want[bytes(s[p : p + 5])] = min(i, want.get(bytes(s[p : p + 5]), i))
    got = smallest_ids(strings, ids, 5, shards)
    assert all(len(g) == max(0, len(s) - 4) and all(g[p] == want[bytes(s[p : p + 5])] for p in range(len(g))) for s, g in zip(strings, got))
