"""Partition layouts: how rows spread over partitions and what a grouped count costs."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.operators.survey import country_counts
from oreflow.session import materialise


def cap_partitions(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` partitions, rows dealt round-robin when there are more.

    The rows are stored first: the number of partitions of anything else is known only
    once it has run, and it would run again for its rows.
    """
    return _capped(materialise(df, "layout"), n)


def _capped(stored: DataFrame, n: int) -> DataFrame:
    return stored.repartition(n) if stored.rdd.getNumPartitions() > n else stored


def dataset_label(df: DataFrame) -> str:
    """``large`` for data in more than one partition; used to name reports. Only the plan is made, nothing is written."""
    return "large" if df.rdd.getNumPartitions() > 1 else "small"


def by_key(df: DataFrame, n: int, key: str) -> DataFrame:
    """``n`` partitions, rows with equal keys together."""
    return df.repartition(n, key)


def rows_per_partition(df: DataFrame, layout: str) -> DataFrame:
    """One row per non-empty partition."""
    return (
        df.groupBy(F.spark_partition_id().alias("partition"))
        .agg(F.count("*").alias("n"))
        .select(F.lit(layout).alias("layout"), "partition", "n")
    )


def profile(df: DataFrame, key: str, n: int = 2) -> DataFrame:
    """Rows per partition of the standard layout, then of the layout by key."""
    df = materialise(df, "layout")
    standard = rows_per_partition(_capped(df, n), "standard")
    keyed = rows_per_partition(by_key(df, n, key), "partition")
    return standard.unionByName(keyed)


def keys_per_layout(df: DataFrame, key: str, n: int = 2) -> DataFrame:
    """Per layout: rows, keys, and keys spread over more than one partition."""
    df = materialise(df, "layout")

    def one(layout: str, placed: DataFrame) -> DataFrame:
        spread = (
            placed.groupBy(key, F.spark_partition_id().alias("partition"))
            .agg(F.count("*").alias("rows"))
            .groupBy(key)
            .agg(F.sum("rows").alias("rows"), F.count("*").alias("places"))
        )
        return spread.agg(
            F.sum("rows").alias("n"),
            F.count("*").alias("keys"),
            F.count_if(F.col("places") > 1).alias("split_keys"),
        ).select(F.lit(layout).alias("layout"), "n", "keys", "split_keys")

    return one("standard", _capped(df, n)).unionByName(one("partition", by_key(df, n, key)))


def timings(survey: DataFrame, n: int = 2) -> DataFrame:
    """Nanoseconds of the grouped count on each layout; each count really runs."""
    rows = []
    survey = materialise(survey, "layout")
    for layout, placed in (
        ("standard", _capped(survey, n)),
        ("partition", by_key(survey, n, "country")),
    ):
        begin = time.perf_counter_ns()
        country_counts(placed).write.format("noop").mode("overwrite").save()
        rows.append((layout, time.perf_counter_ns() - begin))
    return survey.sparkSession.createDataFrame(rows, "layout string, nanoseconds bigint")
