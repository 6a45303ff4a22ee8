"""Token counts of a word-level BPE vocabulary by heap-and-linked-list merging.

The vocabulary file (``tokenizers`` JSON: BPE with word ends, lower case, white
space dropped) gives the merge ranks.  A text is cut into words (Latin text by the
vocabulary's pattern; where a character depends on the Unicode version, by the
library's own normalizer and pre-tokenizer); a word's byte symbols form a linked list, all adjacent pairs with a rank go on a heap, and the
lowest-ranked pair is merged again and again, its new neighbours being pushed.
The count of a word is its initial symbols minus the merges; no identifier is
produced.  Words repeat, so each Python worker keeps the counts of recent words.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, quoted, texts

# Fixed values of the vocabulary's format: its word pattern, special strings and word-end mark.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
SPECIAL = ("<|startoftext|>", "<|endoftext|>")
WORD_END = "</w>"

#: Entries of each of the two generations of a worker's word cache.
CACHE_WORDS = 250_000
#: Bytes of text handled at once; longer texts are cut at white space.
SLICE = 1 << 20

#: Letters (already lower case and composed) followed by ASCII punctuation: two
#: words that the pattern always separates, so their results can be cached apart.
_LETTERS_TAIL = re.compile("([a-zß-öø-ÿ]+)([!-/:-@\\[-`{-~]+)")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte value: printable
    Latin-1 stands for itself, the other bytes take 256, 257, ... in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordCache(dict):
    """chunk -> value, filled by ``make``; keeps the two latest generations."""

    def __init__(self, make, limit: int = CACHE_WORDS):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, chunk: bytes):
        value = self.old.get(chunk)
        if value is None:
            value = self.make(chunk)
        if len(chunk) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[chunk] = value
        return value


def slices(text: bytes, size: int = SLICE) -> Iterator[bytes]:
    """``text`` in pieces of about ``size`` bytes, cut at ASCII white space."""
    start = 0
    while len(text) - start > size:
        cut = max(text.rfind(b" ", start, start + size), text.rfind(b"\n", start, start + size))
        if cut <= start:
            ahead = [x for x in (text.find(b" ", start + size), text.find(b"\n", start + size)) if x >= 0]
            if not ahead:
                break
            cut = min(ahead)
        yield text[start:cut]
        start = cut
    yield text[start:]


def chunks(text: bytes) -> list[bytes]:
    """White-space separated chunks.  ASCII letters are lowered at once unless
    that could create a special string, which is matched on the raw text."""
    return (text if b"<|" in text else text.lower()).split()


def split_tail(chunk: bytes) -> tuple[bytes, bytes] | None:
    """(letters, punctuation) if the chunk is just that, else None."""
    m = _LETTERS_TAIL.fullmatch(chunk.decode())
    return (m[1].encode(), m[2].encode()) if m else None


class WordCounter:
    """Token counts of texts for the vocabulary at ``path``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.symbols = byte_symbols()
        self.word = regex.compile(WORD)
        self.special = re.compile("|".join(map(re.escape, SPECIAL)))
        self.cache = WordCache(self.chunk_tokens)

    def count(self, text: bytes) -> int:
        get = self.cache.__getitem__
        return sum(sum(map(get, chunks(part))) for part in slices(text))

    def chunk_tokens(self, chunk: bytes) -> int:
        """Tokens of a chunk without ASCII white space."""
        if parts := split_tail(chunk):
            return self.cache[parts[0]] + self.cache[parts[1]]
        text = chunk.decode()
        plain = self.special.split(text) if "<|" in text else [text]
        return len(plain) - 1 + sum(self.word_tokens(w) for p in plain for w in self.words(p))

    def words(self, text: str) -> list[str]:
        """The words of ``text``, as byte symbols."""
        if not text or max(text) < "\u0250":  # Latin letters: composed already
            found = self.word.findall("".join(c.lower() for c in text))  # char by char: no final-sigma rule
            return ["".join(self.symbols[b] for b in w.encode()) for w in found]
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]

    def word_tokens(self, word: str) -> int:
        """Initial symbols minus merges."""
        sym: list[str | None] = list(word)
        n, rank = len(sym), self.rank.get
        sym[-1] += WORD_END
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(sym, sym[1:])) if (r := rank((a, b))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, a, b = heapq.heappop(heap)
            k = after[i]
            if sym[i] != a or k >= n or sym[k] != b:
                continue  # one of the two has been merged meanwhile
            sym[i], sym[k] = (ab := a + b), None
            merges += 1
            after[i] = right = after[k]
            if right < n:
                before[right] = i
                if (r := rank((ab, sym[right]))) is not None:
                    heapq.heappush(heap, (r, i, ab, sym[right]))
            if (left := before[i]) >= 0 and (r := rank((sym[left], ab))) is not None:
                heapq.heappush(heap, (r, left, sym[left], ab))
        return n - merges


@lru_cache(maxsize=2)
def counter(path: str) -> WordCounter:
    """One counter for each Python worker and file."""
    return WordCounter(path)


def count_tokens(df: DataFrame, tokenizer: str, text_col: str = "text", id_col: str = "doc_id",
                 limit: int = 2048) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than
    ``limit`` tokens) of every whole text.

    ``tokenizer`` is the path of the vocabulary file on every machine.  No
    shuffle: each scan task counts its own rows, one Arrow batch at a time.
    Null and empty texts have 0 bytes and 0 tokens; a null id stays null;
    repeated rows are counted row by row; other columns are not read, so their
    names cannot clash.  An empty table gives an empty result.
    """
    key, body = fresh(df.select(), "key", "body")
    rows = df.select(quoted(id_col).alias(key), quoted(text_col).cast("string").alias(body))

    def run(batches):
        own = counter(tokenizer)
        for batch in batches:
            found = [(len(t), own.count(t)) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())],
                names=[key, "n_bytes", "n_tokens"])

    kind = rows.schema[key].dataType.simpleString()
    out = rows.mapInArrow(run, f"{key} {kind}, n_bytes long, n_tokens long")
    return out.select(F.col(key).alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
