"""The registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bin_packing, burst_trie, entropy_mixing, language_kernel, line_dedup, merge_dropout, pitman_yor, prefix_counts, projection_forest, quality,
    simhash_trees, spelling_variants, token_blocks,
)
from .folders import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(plan):
    QUERIES[plan.__name__] = plan
    return plan


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, folder, "documents").select("doc_id", "text"))


@_query
def op2_token_blocks(spark: SparkSession, folder: str) -> DataFrame:
    blocks = shared_folder(spark, "token-blocks")
    path = public_tokenizers.path("word_bpe_49k.json")
    token_blocks.write_tokens(_table(spark, folder, "documents"), blocks, path, end_id=1)
    return token_blocks.read_tokens(spark, blocks, with_ids=False)


@_query
def op3_language_kernel(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    away = language_kernel.held_out(F.col("doc_id"), 4)
    model = language_kernel.train(documents.where(~away))
    judged = language_kernel.predict(documents, model)
    return judged.select("doc_id", away.alias("held_out"), "lang_pred", "score")


@_query
def op4_merge_dropout(spark: SparkSession, folder: str) -> DataFrame:
    return merge_dropout.encode(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return bin_packing.pack_documents(_table(spark, folder, "documents"))


@_query
def op7_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    away = language_kernel.held_out(F.col("doc_id"), 7)
    model = pitman_yor.train(documents.where(~away))
    scored = pitman_yor.score(documents, model)
    return scored.select("doc_id", away.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_query
def op8_projection_forest(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = _table(spark, folder, "embeddings")
    return projection_forest.nearest(embeddings, embeddings.where("vec_id % 20 = 0"))


@_query
def op9_simhash_trees(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_trees.near_duplicates(_table(spark, folder, "documents"))


@_query
def op10_prefix_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counts = prefix_counts.count_tokens(_table(spark, folder, "documents"), "doc_id", path, budget=1024)
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@_query
def op11_entropy_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return entropy_mixing.mix(_table(spark, folder, "documents"))


@_query
def op12_burst_trie(spark: SparkSession, folder: str) -> DataFrame:
    return burst_trie.conversation_trie(_table(spark, folder, "conversations"))


@_query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.group_variants(_table(spark, folder, "documents"))


@_query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(_table(spark, folder, "documents"), ["doc_id"])


SQL["op5_quality_rules"] = quality.sql()
