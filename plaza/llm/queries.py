"""The registered queries of this subpackage and the SQL that they must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plaza.llm import conversation_trie, embedding_join, html_text, importance, language, mixing, ngram_join, packing, quality_rules, secret_scan, token_files, url_filter, warc
from plaza.llm.common import table
from plaza.session import new_folder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), TOKENIZER, path)
    return token_files.read_token_files(spark, path)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_language(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents")).drop("row")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op8_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.archived_pages(spark, path).drop("url")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {q.__name__: q for q in (op1_mix_sources, op2_best_fit_packing, op3_token_files, op4_quality_rules, op5_language_id, op6_ngram_join, op7_html_text, op8_embedding_near_dup, op9_secret_scan, op10_url_filter, op11_conversation_trie, op12_warc, op13_importance_resampling)}
ORACLES: dict[str, str] = {"op1_mix_sources": mixing.ORACLE, "op4_quality_rules": quality_rules.ORACLE, "op8_embedding_near_dup": embedding_join.ORACLE, "op10_url_filter": url_filter.ORACLE, "op11_conversation_trie": conversation_trie.ORACLE, "op12_warc": warc.ORACLE, "op13_importance_resampling": importance.ORACLE}
