"""Corpus pipeline: from documents to packed sequences.

STAGES are (name, function) pairs; a function takes (spark, docs, sf_dir) and
returns a DataFrame.  run() writes each stage's result as Parquet to the shared
folder and reads it back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from borderloom.llm.gam import quality_classifier
from borderloom.llm.lines import drop_frequent_lines
from borderloom.llm.ngram_join import drop_near_duplicates
from borderloom.llm.packing import pack_documents
from borderloom.llm.quality_rules import quality_rules
from borderloom.llm.queries import vocabulary_path
from borderloom.llm.store import small_batches, stage


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier gives label 1."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier(docs, labels).where("predicted = 1").select(*docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's perplexity band."""
    small_batches(spark)
    return quality_rules(docs).where("kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that at least 10 of them have; n_chars follows the text."""
    small_batches(spark)
    return drop_frequent_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the Jaccard links, that with the smallest id."""
    small_batches(spark)
    return drop_near_duplicates(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in packed sequences."""
    small_batches(spark)
    return pack_documents(docs, vocabulary_path())


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", rules),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_duplicates),
    ("packing", pack),
]

#: A trained classifier, perplexity, similarity components and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        out = stage(step(spark, out, sf_dir), f"pipeline-{name}")
    return out
