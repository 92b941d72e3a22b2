"""Readers of the input formats. Schemas are stated, never inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATING_SCHEMA = "user string, item string, rating double"
BASKET_SCHEMA = "basket_id string, item string"
MESSAGE_SCHEMA = "id bigint, ts timestamp, text string"


def read_survey(spark: SparkSession, path: str) -> DataFrame:
    """Country, salary and salary type out of a wider CSV with a header; all text.

    Columns are picked by header name, so the scan parses just these three.
    """
    wide = spark.read.option("header", True).csv(path)
    return wide.select(
        F.col("Country").alias("country"), F.col("Salary").alias("salary"), F.col("SalaryType").alias("salary_type")
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """(user, item, rating) from a CSV with a header line."""
    return spark.read.schema(RATING_SCHEMA).option("header", True).csv(path)


def read_baskets(spark: SparkSession, path: str) -> DataFrame:
    """(basket_id, item) pairs from a CSV without a header; further fields are ignored."""
    return spark.read.schema(BASKET_SCHEMA).csv(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One document per line, numbered by its place in the files."""
    lines = spark.read.text(path)
    return lines.select(F.monotonically_increasing_id().alias("doc_id"), F.col("value").alias("text"))


def stream_messages(
    spark: SparkSession,
    path: str,
    file_format: str = "json",
    schema: str | T.StructType = MESSAGE_SCHEMA,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Messages arriving as files; each batch takes at most ``files_per_batch`` of them."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
