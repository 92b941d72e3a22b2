"""Consecutive numbers for the rows of a sorted table, without a single task that sees all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.session import materialise


def numbered(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """``df`` with ``place`` (0, 1, ... along ``order``) and ``part``, the range that a row was sorted in.

    Rows are range-partitioned and sorted once and stored with their place inside the range. The driver
    sees one count per range, and those counts are all that is broadcast. Nulls come first. Rows that
    are equal in ``order`` are numbered in some order.
    """
    # The id's upper bits hold the range, its lower 33 bits the place inside it.
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    stored = materialise(ranged, label).withColumn("part", F.shiftright("_at", 33).cast("int"))
    rows = stored.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    offsets, before = [], 0
    for row in rows:
        offsets.append((row["part"], before))
        before += row["n"]
    starts = df.sparkSession.createDataFrame(offsets, "part int, _before long")
    inside = F.col("_at") - F.shiftleft(F.col("part").cast("long"), 33)
    return stored.join(F.broadcast(starts), "part").withColumn("place", F.col("_before") + inside).drop("_at", "_before")
