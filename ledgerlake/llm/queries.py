"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .common import read


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A vocabulary file that the contracts name."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bytecnn import fit, score_documents

    documents = read(spark, sf_dir, "documents")
    weights = fit(documents, read(spark, sf_dir, "labels"))
    return score_documents(documents, weights).select("doc_id", "held_out", "score", "predicted")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import remove_repeats

    found = remove_repeats(read(spark, sf_dir, "documents"), 50)
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import contamination

    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", F.col("n_words").cast("long"), "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard

    text = F.coalesce(F.col("text"), F.lit(""))
    return shard(read(spark, sf_dir, "documents"), 8).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    pieces = pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .wordbpe import count_tokens

    return count_tokens(read(spark, sf_dir, "documents"), tokenizer_path())


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k

    vectors = read(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    found = near_duplicates(read(spark, sf_dir, "documents"), words=3, distance=2, seed=42)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import format_windows, read_back

    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return read_back(format_windows(turns))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .linededup import dedup_lines

    kept, (n_lines, n_removed, n_runs) = dedup_lines(read(spark, sf_dir, "documents"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return kept.select("doc_id", F.col(n_lines).alias("n_lines"), F.col(n_removed).alias("n_removed"), F.col(n_runs).alias("n_runs"),
                       F.sha2(text.cast("binary"), 256).alias("kept_sha256"))


#: Rules of the url contract: verdict, host and beginning of the path.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page shows the document whose number its url holds; that document's quality label is the page's."""
    from .urlfilter import judge_urls

    marked = (read(spark, sf_dir, "labels").where("doc_id is not null and quality is not null")
              .groupBy(F.col("doc_id").alias("shown")).agg(F.min("quality").alias("good")))
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(F.coalesce("url", F.lit("")), r"://[^/?#]*/[^?#]*?([0-9]{1,18})(?:\.html)?/?(?:[?#]|$)", 1)
    labelled = pages.withColumn("shown", F.when(number != "", number.cast("long"))).join(marked, "shown", "left")
    return judge_urls(labelled, URL_RULES, "good").select("page_id", "host", "path", "rule", "verdict")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact deviation is cast to long, which raises where it doesn't fit (ANSI mode)."""
    from .whitening import whiten

    return whiten(read(spark, sf_dir, "embeddings"), 8).withColumn("deviation", F.col("deviation").cast("long"))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .alignment import align

    return align(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_classifier, op2_suffix_array_dedup, op3_decontamination, op4_sharding, op5_packing,
                            op6_token_counts, op7_top_k, op8_simhash, op9_chat_formatting, op10_line_dedup,
                            op11_url_filter, op12_embedding_whitening, op13_cross_tokenizer_alignment)}

ORACLE: dict[str, str] = oracle.ORACLE
