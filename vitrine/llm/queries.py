"""The numbered queries over the test tables and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import (assignment_secrets, bpe, class_lm, decontaminate, exact_dedup, langid, lloyd, merkle, mixing, mtree, ngram_join, substring_dedup,
                         url_reputation)
from vitrine.llm.sql import ORACLE_SQL  # noqa: F401

#: the public rank file of op2; its place is a parameter, the file is never copied
RANKS = "byte_bpe_multi_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (substring_dedup.repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), window=50)
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))


def tokenizer() -> tuple[str, str]:
    """Place of the rank file and the pattern that splits texts."""
    import public_tokenizers

    return public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = tokenizer()
    return bpe.token_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_components(table(spark, sf_dir, "documents").select("doc_id", "text"), n=5, percent=80)


def op4_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return mtree.top_k(rows, rows.where("vec_id % 20 = 0"), k=20)


def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op7_assignment_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (assignment_secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), keep="max")


def op9_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (url_reputation.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
            .select("page_id", "host", "path", "rule", "verdict"))


def op10_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], tampered={"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1},
                           tamper=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)
    return made.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"), "folded_root", "verified")


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), length=10)
            .select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"))


def op13_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.clusters(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=16, rounds=3, dims=64)


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_mtree_topk": op4_mtree_topk,
    "op5_class_lm": op5_class_lm,
    "op6_cross_parsing": op6_cross_parsing,
    "op7_assignment_secrets": op7_assignment_secrets,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_url_reputation": op9_url_reputation,
    "op10_entropy_mixing": op10_entropy_mixing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_winnowing": op12_winnowing,
    "op13_sharded_lloyd": op13_sharded_lloyd,
}
