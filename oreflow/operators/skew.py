"""Joins on keys that may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot above this share of all rows, so there are fewer than 1 / MAX_SHARE hot keys.
MAX_SHARE = 1 / 512
# Below this many rows a key is never worth splitting.
MIN_ROWS = 200_000


def hot_keys(counts: DataFrame, key: str, n: str, min_rows: int = MIN_ROWS, max_share: float = MAX_SHARE) -> DataFrame:
    """Keys above the limit, with the number of parts to split each into.

    ``counts`` has one row per key with its row count in ``n``. By the share rule
    the result has fewer than ``1 / max_share`` rows, whatever the data.
    """
    total = counts.agg(F.sum(n)).first()[0] or 0
    limit = max(float(min_rows), float(total) * max_share)
    return counts.filter(F.col(n) > limit).select(key, F.ceil(F.col(n) / limit).cast("int").alias("_parts"))


def salted_join(many: DataFrame, few: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Inner join on ``key`` with the rows of hot keys spread over several tasks.

    Rows of ``many`` take a part number from a hash of the row, which a retried task
    repeats exactly; rows of ``few`` are copied once to each part of their key.
    The broadcast side is bounded by ``hot_keys``.
    """
    parts = F.broadcast(hot)
    row_hash = F.xxhash64(*[F.col(c) for c in many.columns])
    spread = (
        many.join(parts, key, "left")
        .withColumn("_part", F.coalesce(F.pmod(row_hash, F.col("_parts")).cast("int"), F.lit(0)))
        .drop("_parts")
    )
    copied = (
        few.join(parts, key, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
        .drop("_parts")
    )
    return spread.join(copied, [key, "_part"]).drop("_part")
