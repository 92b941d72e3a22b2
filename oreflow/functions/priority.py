"""Repeatable pseudo-random ordering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def priority(seed: int | str, key: Column) -> Column:
    """A hash of seed and key. Sorting by it shuffles rows the same way every time,
    so a retried task or another engine picks the same sample."""
    return F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string")).cast("binary"))
