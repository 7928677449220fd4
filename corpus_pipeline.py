"""A training corpus out of ``documents``: stages that each apply one operator.

Every stage takes the documents that its predecessor kept, as (spark, docs,
sf_dir), and returns a DataFrame, which :func:`run` writes and reads again.
Quality rules and toxicity learn from the labels in ``sf_dir``. Stages work on
whole texts and all rows; null and empty texts, repeated rows and clashing
column names are as the operators say.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.llm import line_dedup as lines
from kindling.llm import near_dup, packing
from kindling.llm import quality as rules
from kindling.llm import toxicity as ordinal
from kindling.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base checks and the learned decision list."""
    return rules.quality_filter(spark, docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely than not of the grade 0."""
    return ordinal.toxicity_filter(spark, docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a document of smaller id holds; ``n_chars`` is counted again."""
    shorter = lines.drop_lines(spark, docs).select(*docs.columns)
    return shorter.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else shorter


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    return near_dup.one_of_each(spark, docs, n_words=5)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in packed sequences."""
    return packing.pack_documents(spark, docs, public_tokenizers.path(packing.TOKENIZER), with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the learned rules and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus: applies the stages to ``documents``, each on what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
