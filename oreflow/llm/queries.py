"""Registered queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm import (
    byte_bpe,
    chosen_path,
    collocations,
    html_text,
    importance,
    line_dedup,
    merkle,
    packing,
    personal,
    quality_rules,
    secrets,
    suffix_dedup,
    topk,
)
from oreflow.llm.common import read_table


def op1_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(read_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digest(read_table(spark, folder, "documents"), length=100)


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digest(read_table(spark, folder, "documents"), threshold=10)


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digest(read_table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.digest(read_table(spark, folder, "pages"))


def op6_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.digest(read_table(spark, folder, "documents"), words=2, percent=80)


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(read_table(spark, folder, "documents"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digest(read_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.digest(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.digest(read_table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.digest(read_table(spark, folder, "documents"))


def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal.digest(read_table(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.digest(read_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_topk": op1_exact_topk,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_html_text": op5_html_text,
    "op6_chosen_path": op6_chosen_path,
    "op7_secret_scan": op7_secret_scan,
    "op8_packing": op8_packing,
    "op9_importance_resampling": op9_importance_resampling,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_personal_data": op12_personal_data,
    "op13_collocations": op13_collocations,
}
