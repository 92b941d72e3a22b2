"""Top-k search against brute force."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label string"


LEAST, MOST = -(2**63), 2**63 - 1


def brute(rows, k):
    """One list per query row; rows are told apart, scores end where longs do."""
    usable = [(i, v) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    usable = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in usable if all(abs(64 * float(np.float32(x))) < 2.0**62 for x in v)]
    found = Counter()
    for n, (i, q) in enumerate(usable):
        if i % 20 == 0:
            others = [(j, v) for m, (j, v) in enumerate(usable) if m != n and len(v) == len(q)]
            near = sorted((-min(max(sum(a * b for a, b in zip(q, v, strict=True)), LEAST), MOST), j) for j, v in others)[:k]
            found.update((i, rank, j, -score) for rank, (score, j) in enumerate(near, 1))
    return found


def rows_of(frame):
    return Counter(tuple(row) for row in frame.collect())


@pytest.mark.parametrize(("shard", "strip", "block", "fan_in"), [(16384, 1024, 2048, 16), (40, 16, 3, 2)])
def test_brute_force(spark, monkeypatch, shard, strip, block, fan_in):
    for name, value in (("SHARD", shard), ("STRIP", strip), ("BLOCK", block), ("FAN_IN", fan_in)):
        monkeypatch.setattr(topk, name, value)
    random = np.random.default_rng(3)
    rows = [(i, [float(x) for x in random.integers(-3, 4, 4) / 8], None) for i in range(300)]
    rows += [rows[0], (7, None, "a"), (None, [1.0] * 4, "b"), (8, [1.0, None, 0.0, 0.0], "c"), (9, [math.nan] * 4, "d"), (10, [math.inf] * 4, "e")]
    rows += [(20, [0.5] * 4, "same id"), (500, [3.0, 4.0], "shorter"), (540, [1.0, 2.0], "shorter")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).withColumn("part", F.lit(2))
    assert rows_of(topk.search(frame, F.col("vec_id") % 20 == 0, k=5)) == brute(rows, 5)


def test_products_beyond_doubles(spark):
    rows = [(0, [1e8, 1.0], None), (1, [1e8, 2.0], None), (2, [1e8, 3.0], None), (20, [-1e8, 5.0], None), (40, [3e7, 7.0], None), (3, [3e7, 9.0], None)]
    assert rows_of(topk.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=3)) == brute(rows, 3)


def test_components_out_of_range(spark):
    rows = [(0, [1.0, 1.0], None), (1, [1e30, 2.0], None), (2, [-1e30, 3.0], None), (20, [1e30, 5.0], None), (3, [7e16, 0.0], None), (4, [8e16, 0.0], None)]
    got = rows_of(topk.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=5))
    assert got == brute(rows, 5) and {vec_id for _, _, vec_id, _ in got} == {3}


def test_empty(spark):
    assert topk.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
