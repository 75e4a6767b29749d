"""The corpus pipeline: language, exact copies, near copies, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each
stage's result as Parquet into the shared folder of `spark.checkpoint.dir` and
rereads it as the next stage's docs.  All but the last return the columns of
documents.  No SQL states a suffix-automaton language model or byte-pair merges,
so ORACLE_SQL is None and the tests hold the pipeline against plain Python.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import bpe, exact_dedup, langid, mixing, ngram_join
from vitrine.llm.queries import tokenizer
from vitrine.session import ensure_checkpoint_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text's language is found and written into lang; texts without any (null, no letter) go."""
    return langid.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return exact_dedup.drop_exact_duplicates(docs, keep="max")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of their 5-word shingles the smallest doc_id stays."""
    return ngram_join.drop_near_duplicates(docs, n=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out, taken once or twice, so that the sources meet their word targets."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy, with the digests of the ids and of what they decode to."""
    path, pattern = tokenizer()
    return bpe.token_digests(docs, path, pattern, carry=("doc_id", "lang", "source"))


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("byte-level BPE", tokenize),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
