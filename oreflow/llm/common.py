"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The characters that separate words and are stripped from lines: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character kept."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


# What a Python worker gets at once, at most; a longer text comes alone.
BATCH_BYTES, _SETTING = "16m", "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the texts that a Python worker holds, unless the session has a bound of its own."""
    if spark.conf.get(_SETTING) in ("67108864b", "64MB", "67108864"):  # Spark's default
        spark.conf.set(_SETTING, BATCH_BYTES)


def documents_only(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of every row; a null text becomes the empty text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def free_name(columns: list[str], wanted: str) -> str:
    """A column name near ``wanted`` that no column has, upper and lower case taken as equal."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def two_hashes(*columns: Column) -> list[Column]:
    """Two 64-bit hashes with different seeds, which together identify a value."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns)]
