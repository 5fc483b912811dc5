"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plaza.llm import language, mixing, ngram_join, packing, secret_scan
from plaza.llm.common import Scratch

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay."""
    return language.keep_identified(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies stays."""
    return ngram_join.keep_one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced."""
    return secret_scan.remove_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated by their source's rate and shuffled."""
    return mixing.mix_sources(docs, numbered=False)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 2048."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("secret scans", secret_scans),
    ("mixing sources", mix_sources),
    ("best-fit packing", best_fit_packing),
]

# Hashed n-grams, a forest and token ids are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark)
    for number, (_, function) in enumerate(STAGES):
        docs = scratch.write(function(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
