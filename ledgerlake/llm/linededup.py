"""Line dedup by a suffix array over line ids, with DataFrame functions only.

Every document is a string of line ids.  Prefix doubling ranks the suffixes: the
rank of a suffix by its first 2h lines is the place of the pair (rank by h lines,
rank by h lines of the suffix h lines further) among all sorted pairs.  Pairs are
sorted by range partitions, and only suffixes that still share their rank go on.
Sorted by rank the suffixes form the suffix array; neighbours with one rank share
a prefix of at least h lines, and these longest-common-prefix intervals hold the
copies of repeated runs.  In each interval the first copy stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize, quoted

#: A rank shared by more than this part of all suffixes is hot; there are fewer than 1 / HOT such ranks.
HOT = 1 / 1000


def numbered_lines(docs: DataFrame) -> DataFrame:
    """(doc, order, pos, n, size, a, b): a row per line; a and b are its 128-bit id."""
    lines = docs.select("doc", "order", F.split("text", "\n").alias("lines"))
    return (lines.select("doc", "order", F.size("lines").alias("n"), F.posexplode("lines").alias("pos", "line"))
            .select("doc", "order", "pos", "n", F.char_length("line").alias("size"), F.xxhash64("line").alias("a"),
                    F.xxhash64(F.lit(1), "line").alias("b")))


def ranks(pairs: DataFrame, partitions: int) -> DataFrame:
    """(a, b, n, rank): the different pairs in sorted order, numbered from 1 (gaps allowed).

    Range partitions are sorted one by one; a partition's number is the high part of a rank.
    """
    sorted_ = pairs.repartitionByRange(partitions, "a", "b").sortWithinPartitions("a", "b")
    return sorted_.withColumn("rank", F.monotonically_increasing_id() + 1)


def rank_suffixes(suffixes: DataFrame, total: int, partitions: int) -> DataFrame:
    """Replaces the pair (a, b) of each suffix by its rank; suffixes with a rank of their own are dropped.

    Hot pairs are joined by broadcast (fewer than 1 / HOT rows), the others by shuffle.
    """
    counted = suffixes.groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    table = materialize(ranks(counted, partitions), "ranks")
    limit = max(1, int(total * HOT))
    hot = table.where(F.col("n") > limit).select("a", "b", F.col("rank").alias("hot_rank"))
    cold = table.where(F.col("n") <= limit).select("a", "b", "rank")
    marked = suffixes.join(F.broadcast(hot), ["a", "b"], "left")
    found = marked.where(F.col("hot_rank").isNull()).drop("hot_rank").join(cold, ["a", "b"])
    same = marked.where(F.col("hot_rank").isNotNull()).withColumnRenamed("hot_rank", "rank")
    return found.unionByName(same).drop("a", "b")


def doubled(ranked: DataFrame, step: int) -> DataFrame:
    """Suffixes with the pair (own rank by h lines, that of the suffix ``step`` <= h lines further),
    which stands for their first h + step lines; those without a full second part, or
    whose second part is unique, repeat no run of that length."""
    further = ranked.select("doc", (F.col("pos") - step).alias("pos"), F.col("rank").alias("b"))
    return ranked.withColumnRenamed("rank", "a").join(further, ["doc", "pos"])


def later_copies(ranked: DataFrame, lines: int) -> DataFrame:
    """(doc, pos, lines) of the suffixes in an interval of common prefixes that aren't its first."""
    first = ranked.groupBy("rank").agg(F.min(F.struct("order", "doc", "pos")).alias("first"), F.count("*").alias("n"))
    total = ranked.count()
    limit = max(1, int(total * HOT))
    hot = F.broadcast(first.where(F.col("n") > limit).select("rank", F.col("first").alias("hot_first")))
    marked = ranked.join(hot, "rank", "left")
    cold = (marked.where(F.col("hot_first").isNull()).drop("hot_first")
            .join(first.where((F.col("n") <= limit) & (F.col("n") > 1)).select("rank", "first"), "rank"))
    both = cold.unionByName(marked.where(F.col("hot_first").isNotNull()).withColumnRenamed("hot_first", "first"))
    own = F.struct("order", "doc", "pos")
    return both.where(own != F.col("first")).select("doc", "pos", F.lit(lines).alias("lines"))


def repeated_runs(lines: DataFrame, min_lines: int, min_chars: int) -> DataFrame:
    """(doc, pos, lines): later copies of repeated runs.

    A run counts from ``min_lines`` lines on, or from one line of at least
    ``min_chars`` characters.  Doubling goes on until the ranks hold ``min_lines``
    lines; the last step overlaps where that is no power of two.
    """
    if min_lines < 2:
        raise ValueError("min_lines must be at least 2")
    total = lines.count()
    partitions = max(1, -(-total // 2_000_000), int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranked = materialize(rank_suffixes(lines.drop("n"), total, partitions), "suffixes")
    found = later_copies(ranked.where(F.col("size") >= min_chars), 1)
    h = 1
    while h < min_lines:
        step = min(h, min_lines - h)
        ranked = materialize(rank_suffixes(doubled(ranked, step), total, partitions), "suffixes")
        h += step
    return found.unionByName(later_copies(ranked, min_lines))


def maximal_runs(copies: DataFrame) -> DataFrame:
    """(doc, start, stop): the copies' lines as maximal runs (islands of covered lines)."""
    covered = copies.select("doc", F.explode(F.sequence("pos", F.col("pos") + F.col("lines") - 1)).alias("pos")).distinct()
    run = F.col("pos") - F.row_number().over(Window.partitionBy("doc").orderBy("pos"))
    return covered.withColumn("run", run).groupBy("doc", "run").agg(F.min("pos").alias("start"), F.max("pos").alias("stop")).drop("run")


def dedup_lines(df: DataFrame, min_lines: int = 4, min_chars: int = 20, id_col: str = "doc_id",
                text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """All rows and columns of ``df`` with the later copies of repeated line runs
    deleted from the text, and the names of three added columns: the numbers of
    lines, of removed lines and of removed runs.

    A line goes if it lies in a run of ``min_lines`` lines, or is a line of at
    least ``min_chars`` characters, that also starts earlier: in a row with a
    smaller id (null ids come first, equal ids in input order) or further up in
    the same text; matches are judged on the input.  Runs never cross texts.  A
    null text has one empty line and stays null; a text all of whose lines go
    becomes empty; repeated rows keep their first copy's lines.  An empty table
    gives an empty result.

    The rows are written once to the shared folder with a row number; only line
    ids are sorted and joined, the texts are shuffled once at the end.
    """
    doc, n_lines, n_removed, n_runs, cut = fresh(df, "doc", "n_lines", "n_removed", "n_runs", "cut")
    rows = materialize(df.withColumn(doc, F.monotonically_increasing_id()), "documents")
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    lines = materialize(numbered_lines(rows.select(F.col(doc).alias("doc"), quoted(id_col).alias("order"), text.alias("text"))), "lines")
    runs = maximal_runs(repeated_runs(lines, min_lines, min_chars))
    cuts = runs.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias(cut),  # no longer than the text
                                   F.sum(F.col("stop") - F.col("start") + 1).alias(n_removed), F.count("*").alias(n_runs))
    joined = rows.join(cuts.withColumnRenamed("doc", doc), doc, "left")
    kept = F.when(F.col(cut).isNull(), quoted(text_col)).otherwise(keep_between(F.split(text, "\n"), F.col(cut)))
    out = joined.select(*(kept.alias(c) if c.lower() == text_col.lower() else quoted(c) for c in df.columns),
                        F.size(F.split(text, "\n")).cast("long").alias(n_lines), F.coalesce(n_removed, F.lit(0)).cast("long").alias(n_removed),
                        F.coalesce(n_runs, F.lit(0)).cast("long").alias(n_runs))
    return out, [n_lines, n_removed, n_runs]


def keep_between(lines: Column, cut: Column) -> Column:
    """The lines outside the sorted, disjoint (start, stop) runs, joined again."""
    starts = F.concat(F.array(F.lit(0)), F.transform(cut, lambda r: r["stop"] + 1))
    stops = F.concat(F.transform(cut, lambda r: r["start"]), F.array(F.size(lines)))
    parts = F.zip_with(starts, stops, lambda a, b: F.slice(lines, a + 1, b - a))
    return F.array_join(F.flatten(parts), "\n")
