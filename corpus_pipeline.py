"""A training corpus from raw documents: five stages, each an operator of ``docgraph.llm``, each over all that the one before kept.

Stages take (spark, docs, sf_dir) and return the rows that stay, with all their columns; the last one returns the pieces of the packed
windows. Between stages the documents are written as Parquet to the folder all executors share and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.fixtures import table
from docgraph.llm.decontamination import passages_of
from docgraph.llm.language import language_of, train_language_model
from docgraph.llm.near_duplicates import without_near_duplicates
from docgraph.llm.packing import pack_documents
from docgraph.llm.text import small_batches
from docgraph.llm.toxicity import THRESHOLD, toxicity_of, train_toxicity_model
from docgraph.plans.scratch import write_table

TOKENIZER = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with calibrated confidence; texts without a letter go."""
    small_batches(spark)
    return docs.filter(language_of(F.col("text"), train_language_model(docs))["accepted"])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    small_batches(spark)
    model = train_toxicity_model(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity_of(F.col("text"), model) < THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of at least 0.8."""
    return without_near_duplicates(docs, shingle_words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    small_batches(spark)
    return docs.filter(F.size(passages_of(F.col("text"), table(spark, sf_dir, "benchmark"))) == 0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in windows of 4096 tokens."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Trained models, alignments and token ids can't be expressed in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
