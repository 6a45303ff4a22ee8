"""The registered queries: SQL oracles and contracts on the smallest driver tables."""

from scripts.check_oracle import compare

from ledgerlake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_queries_equal_their_sql(spark):
    assert compare(spark, SF, ORACLE, verbose=False) == dict.fromkeys(ORACLE, "OK")


def test_columns(spark):
    want = {"op1_quality_classifier": "doc_id held_out score predicted", "op2_suffix_array_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
            "op4_sharding": "doc_id size text_crc32 law shard slot grown_shard", "op6_token_counts": "doc_id n_bytes n_tokens over_limit",
            "op8_simhash": "doc_id fingerprint component_id",
            "op13_cross_tokenizer_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256"}
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, columns in want.items():
        found = QUERIES[name](spark, SF)
        assert found.columns == columns.split(), name
        assert found.count() == n, name
