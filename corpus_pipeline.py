"""From raw documents to token ids of a balanced corpus, in five stages.

Each stage reads what its predecessor wrote as Parquet; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronoloom.llm import bpe, exact_dedup, mixing, quality, shingle_join
from chronoloom.llm.queries import TOKENIZER, find_package
from chronoloom.session import scratch_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among them."""
    find_package(spark)
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.distinct_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles."""
    find_package(spark)
    return shingle_join.one_of_each(docs)


def balance_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target weight wants it."""
    return mixing.mixed_documents(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix: doc_id, n_tokens, ids."""
    import public_tokenizers

    find_package(spark)
    return bpe.encode_documents(docs, public_tokenizers.path(TOKENIZER)).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", balance_sources),
    ("BPE encoding", to_tokens),
]

ORACLE_SQL = None  # a trained classifier and entropy balancing have no SQL form; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            path = scratch_path(spark, f"pipeline-{number}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
