"""The corpus pipeline: documents to token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame. ``run`` writes what a stage returns to the shared
folder and hands the next one the table as it is read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.llm import bpe, exact_dedup, mixing, quality_divergence, simhash_trie
from forgeline.llm.queries import bpe_pattern, tokenizer_path
from forgeline.llm.shared import ship_package, write_shared


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality_divergence.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.keep_distinct(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the smallest doc_id."""
    ship_package(spark)
    return simhash_trie.keep_one_of_each(docs, shingle=4, max_bits=4)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids of each taken document; the ids are decoded and
    compared with the text on the way."""
    ship_package(spark)
    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(docs, path, bpe_pattern(), check=True).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("mixing", mixture),
    ("byte-level bpe", encoding),
]

#: hash keys, tries and merges have no SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = write_shared(docs, f"pipeline-{i}")
    return docs
