"""The corpus pipeline: from the documents table to packed training sequences.

Each stage takes the documents that the one before kept, written as Parquet and read again. All but
the last return the columns of documents; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm import chosen_path, importance, line_dedup, packing, secrets
from oreflow.llm.common import read_table
from oreflow.session import materialise


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs``, with the number of characters as it is now."""
    return docs.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns))


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling towards the labelled good ones."""
    return importance.select(docs, read_table(spark, sf_dir, "labels"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least ten of them share."""
    return _counted(line_dedup.remove_frequent_lines(docs, threshold=10), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return chosen_path.deduplicate(docs, words=5, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced."""
    return _counted(secrets.clean(docs), docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 4,096 tokens that hold the documents."""
    return packing.digest(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", keep_good_documents),
    ("line_dedup", drop_shared_lines),
    ("near_duplicates", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("packing", pack_documents),
]

# The first stage draws by trained models and the last uses a tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
