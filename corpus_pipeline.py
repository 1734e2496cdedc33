"""A training-corpus pipeline of five stages, each one operator of ``forumlens.llm``.

Each stage takes all that its predecessor kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm import line_suffixes, order_minhash, toxicity, unigram, winnowing
from forumlens.llm.text import DOCUMENT_COLUMNS, table
from forumlens.session import scratch_path


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*DOCUMENT_COLUMNS)


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go; it learns from the labels of this table."""
    return _documents(toxicity.drop_toxic(_documents(docs), table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; a document all of whose lines are such copies goes with them.

    ``n_chars`` is that of the text that is left.
    """
    cut = line_suffixes.drop_repeated_runs(_documents(docs))
    left = cut.filter((F.col("n_left") > 0) | (F.col("n_removed") == 0))
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return _documents(left.withColumn("n_chars", chars))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return _documents(order_minhash.drop_near_duplicates(_documents(docs)))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return _documents(winnowing.drop_contaminated(_documents(docs), table(spark, sf_dir, "benchmark")))


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the piece ids of their text, their number, and whether they decode to the very text."""
    coded = unigram.encode(_documents(docs), decoded="decoded")
    return coded.select(
        *DOCUMENT_COLUMNS, F.size("ids").cast("long").alias("n_pieces"), "ids",
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


STAGES = [
    ("toxicity", toxic_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", tokenization),
]

# The trained classifier can't be said in SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
