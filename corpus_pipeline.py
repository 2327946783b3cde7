"""From raw documents to packed sequences: five stages, each a table written and read again.

A stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before kept.  All but the last
return the columns of ``documents``; line dedup changes ``text`` and with it ``n_chars``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from benchloom.llm import bin_packing, language_kernel, line_dedup, quality, shingle_sets, simhash_trees
from benchloom.llm.folders import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a language: no letter, or no language that stands out."""
    model = language_kernel.train(docs.where(~language_kernel.held_out(F.col("doc_id"), 4)))
    return language_kernel.keep_known(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts that break a quality rule."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one occurrence of near-equal lines; a document that loses its last line with a word goes."""
    cleaned = line_dedup.dedup_lines(docs).where("n_dropped = 0 OR n_dropped < n_lines")
    changed = F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", changed).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose five-word shingles have a Jaccard similarity of 0.8 or more.

    Candidates are what BK-trees over SimHashes connect, and what shares a MinHash band; all are compared exactly.
    """
    prints = stored(shingle_sets.set_prints(docs, bands=True), "prints")
    found = shingle_sets.groups(docs, prints)
    return simhash_trees.keep_first(docs, "doc_id", "text", prints.select("key", "fp"), found, shingle_sets.set_prints)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place the documents in sequences."""
    return bin_packing.pack_documents(docs)


STAGES = [
    ("language_id", language),
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("best_fit_packing", packing),
]

#: Kernel scores, edit distances and groups are not for SQL: the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
