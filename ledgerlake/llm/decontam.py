"""Benchmark decontamination with a distributed positional inverted index.

DataFrame functions only.  The index stores, for every occurrence of a benchmark
word in the training texts, a posting (word, document, position).  Each window of
benchmark words is looked up from its rarest words: their postings, shifted by the
word's offset, give alignments (document, item, place of the item's first word),
which are intersected with the shifted postings of the next rarest word and at last
with those of all words of the item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, quoted, table_bytes

#: Everything that is no word character: ASCII other than 0-9, A-Z and a-z.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Rows and bytes of words of a benchmark-sized table up to which it is broadcast; beyond, Spark joins by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def raw_words(text: Column) -> Column:
    """The words of a text in their own case; null has none."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), _GAP), "")


def is_small(table: DataFrame, *word_cols: str) -> bool:
    """Whether a written table's rows and the bytes of its words are within the broadcast bound (a word may be a whole text)."""
    return table.count() <= BROADCAST_ROWS and table_bytes(table, *word_cols) <= BROADCAST_BYTES


def small(df: DataFrame, measured: bool) -> DataFrame:
    """Broadcast a table (or its narrower projection) that was measured to be small."""
    return F.broadcast(df) if measured else df


def benchmark_words(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, k, word, length): every word of every item; ``item`` numbers the rows."""
    words = F.transform(raw_words(quoted(text_col)), lower_ascii)
    items = benchmark.select(F.monotonically_increasing_id().alias("item"), quoted(id_col).alias("item_id"), words.alias("words"))
    return materialize(items.select("item", "item_id", F.size("words").alias("length"), F.posexplode("words").alias("k", "word")),
                       "benchmark-words")


def build_index(df: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The stored index: (doc, doc_id, n_words, pos, word).

    ``word`` is a benchmark word.  Each document's first row is kept whatever its
    word (then null), so that documents without postings stay known.
    """
    words = df.select(F.monotonically_increasing_id().alias("doc"), quoted(id_col).alias("doc_id"), raw_words(quoted(text_col)).alias("words"))
    each = words.select("doc", "doc_id", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("pos", "raw"))
    # lower() is cheaper and does the same to words of ASCII alone
    plain = F.octet_length("raw") == F.char_length("raw")
    known = small(vocabulary.select("word"), is_small(vocabulary, "word"))
    index = (each.join(known, F.when(plain, F.lower("raw")).otherwise(lower_ascii(F.col("raw"))) == F.col("word"), "left")
             .where(F.col("word").isNotNull() | F.col("pos").isNull() | (F.col("pos") == 0))
             .select("doc", "doc_id", "n_words", "pos", "word"))
    return materialize(index, "postings")


def windows_by_rarity(words: DataFrame, postings: DataFrame, size: int, depth: int) -> DataFrame:
    """(item, length, k1, word1, k2, word2, ...): places of the ``depth`` rarest words of each window.

    Windows that share their rarest words share a row; a missing word has never
    a posting, so its windows are left out.
    """
    counts = postings.groupBy("word").agg(F.count("*").alias("n"))
    rated = words.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    first = F.greatest(F.col("k") - (size - 1), F.lit(0))
    last = F.least(F.col("k"), F.greatest(F.col("length") - size, F.lit(0)))
    in_windows = rated.withColumn("start", F.explode(F.sequence(first, last)))
    sets = in_windows.groupBy("item", "length", "start").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("n", "k", "word"))), 1, depth).alias("rare"))  # at most ``size`` words
    sets = sets.where(F.col("rare")[0]["n"] > 0)
    return sets.select("item", "length", *(F.get("rare", F.lit(j))[c].alias(f"{c}{j + 1}") for j in range(depth) for c in ("k", "word"))).distinct()


def alignments(index: DataFrame, rare: DataFrame, depth: int) -> DataFrame:
    """(doc, item, at): where the shifted postings of a window's rarest words all meet."""
    postings = index.select("doc", "pos", "word").where(F.col("word").isNotNull())
    measured = is_small(rare, *(f"word{j}" for j in range(1, depth + 1)))
    found = (postings.join(small(rare, measured), F.col("word") == F.col("word1"))
             .withColumn("at", F.col("pos") - F.col("k1")).drop("pos", "word"))
    for j in range(2, depth + 1):
        own = (postings.join(small(rare.select(F.col(f"word{j}").alias("word")).distinct(), measured), "word", "left_semi")
               .select(F.col("doc").alias("doc_j"), F.col("pos").alias("pos_j"), F.col("word").alias("word_j")))
        short = found.where(F.col(f"word{j}").isNull())  # windows of fewer words
        met = (found.join(own, (F.col("doc") == F.col("doc_j")) & (F.col("at") + F.col(f"k{j}") == F.col("pos_j"))
                          & (F.col(f"word{j}") == F.col("word_j"))).drop("doc_j", "pos_j", "word_j"))
        found = met.unionByName(short)
    return found.select("doc", "item", "at").distinct()


def phrase_hits(index: DataFrame, words: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """(doc, item, start, stop): maximal runs of document positions that match an
    item's consecutive words and hold a whole window."""
    found = materialize(found, "alignments")
    expected = (found.join(words.select("item", "k", "word", "length"), "item")
                .select("doc", "item", "at", "k", "length", (F.col("at") + F.col("k")).alias("pos"), "word"))
    touched = found.select("doc").distinct()
    postings = index.select("doc", "pos", "word").where(F.col("word").isNotNull()).join(touched, "doc", "left_semi")
    matched = expected.join(postings, ["doc", "pos", "word"])
    order = Window.partitionBy("doc", "item", "at").orderBy("k")
    runs = matched.withColumn("run", F.col("k") - F.row_number().over(order))
    return (runs.groupBy("doc", "item", "at", "run")
            .agg(F.count("*").alias("n"), F.min("pos").alias("start"), F.max("pos").alias("stop"), F.first("length").alias("length"))
            .where(F.col("n") >= F.least(F.lit(size), "length")).select("doc", "item", "start", "stop"))


def proximity_matches(df: DataFrame, benchmark: DataFrame, slop: int, size: int = 13, terms: int = 3, id_col: str = "doc_id",
                      item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id) whose texts hold the ``terms`` rarest words of a window of
    the item, each displaced by at most ``slop`` positions from its place relative
    to the rarest one.  Empty, null and repeated rows as in ``contamination``."""
    words = benchmark_words(benchmark, item_col, text_col)
    vocabulary = materialize(words.select("word").distinct(), "vocabulary")
    index = build_index(df, vocabulary, id_col, text_col)
    postings = index.select("doc", "pos", "word").where(F.col("word").isNotNull())
    rare = materialize(windows_by_rarity(words, postings, size, terms), "rare")
    measured = is_small(rare, *(f"word{j}" for j in range(1, terms + 1)))
    found = (postings.join(small(rare, measured), F.col("word") == F.col("word1"))
             .withColumn("at", F.col("pos") - F.col("k1")).drop("pos", "word"))
    for j in range(2, terms + 1):
        # equal cells of slop + 1 positions, or neighbouring ones, hold all displacements up to slop
        own = (postings.join(small(rare.select(F.col(f"word{j}").alias("word")).distinct(), measured), "word", "left_semi")
               .select(F.col("doc").alias("doc_j"), F.col("pos").alias("pos_j"), F.col("word").alias("word_j"),
                       F.floor(F.col("pos") / (slop + 1)).alias("cell")))
        goal = F.col("at") + F.col(f"k{j}")
        cell = F.floor(goal / (slop + 1))
        wide = found.where(F.col(f"word{j}").isNotNull()).withColumn("near", F.explode(F.array(cell - 1, cell, cell + 1)))
        met = wide.join(own, (F.col("doc") == F.col("doc_j")) & (F.col("near") == F.col("cell")) & (F.col(f"word{j}") == F.col("word_j"))
                        & (F.abs(goal - F.col("pos_j")) <= slop), "left_semi").drop("near")
        found = met.unionByName(found.where(F.col(f"word{j}").isNull()))
    ids = words.select("item", "item_id").distinct()
    docs = index.where(F.col("pos").isNull() | (F.col("pos") == 0)).select("doc", "doc_id")
    return found.select("doc", "item").distinct().join(ids, "item").join(docs, "doc").select(F.col("doc_id").alias(id_col), "item_id").distinct()


def contamination(df: DataFrame, benchmark: DataFrame, size: int = 13, depth: int = 3, share: int = 20, id_col: str = "doc_id",
                  item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_hit, n_items, items, contaminated) of every row of ``df``.

    A window is ``size`` consecutive words of an item, or all words of a shorter
    one.  Words inside an occurrence of a window are hit; ``items`` holds the ids
    of the items with occurring windows, sorted as strings (a null id is left out
    of it, but counted); a row is contaminated if ``share * n_hit >= n_words`` and
    n_hit is not 0.  Null and empty texts have no words; repeated rows of either
    table count one by one (items with one id once); columns other than id and
    text are not read; an empty table of documents gives an empty result, an empty
    benchmark no hits.

    Only A-Z are lowered: other letters whose lower case is ASCII (the Kelvin sign) stay as they are.
    Broadcast are only tables made of benchmark words, behind a count of rows and bytes.
    """
    words = benchmark_words(benchmark, item_col, text_col)
    vocabulary = materialize(words.select("word").distinct(), "vocabulary")
    index = build_index(df, vocabulary, id_col, text_col)
    rare = materialize(windows_by_rarity(words, index.where(F.col("word").isNotNull()), size, depth), "rare")
    hits = materialize(phrase_hits(index, words, alignments(index, rare, depth), size), "hits")
    n_hit = (hits.select("doc", F.explode(F.sequence("start", "stop")).alias("pos")).distinct()
             .groupBy("doc").agg(F.count("*").alias("n_hit")))
    ids = words.select("item", "item_id").distinct()
    of = hits.select("doc", "item").distinct().join(ids, "item").select("doc", "item_id").distinct()
    items = of.groupBy("doc").agg(F.count("*").alias("n_items"),
                                  F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items"))  # benchmark-sized
    docs = index.where(F.col("pos").isNull() | (F.col("pos") == 0)).select("doc", "doc_id", F.col("n_words").cast("long"))
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (docs.join(n_hit, "doc", "left").join(items, "doc", "left")
            .select(F.col("doc_id").alias(id_col), "n_words", hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    ((hit > 0) & (hit * share >= F.col("n_words"))).alias("contaminated")))


def keep_clean(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``df`` whose id has no contaminated row, with the columns of ``df``."""
    found = contamination(df, benchmark, id_col=id_col, **options)
    bad = found.where("contaminated").select(F.col(id_col).alias("bad")).distinct()
    return df.join(bad, quoted(id_col).eqNullSafe(F.col("bad")), "left_anti").select(*map(quoted, df.columns))
