"""The Merkle manifest against a tree built row by row."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def leaf(row):
    parts = [None if v is None else str(v).encode() for v in row]
    return sha(b"".join(b"-" if p is None else str(len(p)).encode() + b":" + p for p in parts))


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, i):
    for level in levels[:-1]:
        first = i // 16 * 16
        yield i - first, level[first : first + 16]
        i //= 16


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    for name in names:
        groups[name].sort(key=lambda row: (row[0] is not None, row[0] or 0, leaf(row)))
    trees = {name: tree([leaf(row) for row in groups[name]]) for name in names}
    top = tree([trees[name][-1][0] for name in names])
    found = []
    for place, name in enumerate(names):
        for i, row in enumerate(groups[name]):
            steps = [*path(trees[name], i), *path(top, place)]
            value = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                value = leaf((*row[:4], row[4].translate(LOWER)))
            for at, run in steps:
                value = sha("".join([*run[:at], value, *run[at + 1 :]]))
            proof = sha("".join("".join(run[:at] + run[at + 1 :]) for at, run in steps))
            found.append((row[0], trees[name][0][i], trees[name][-1][0], top[-1][0], proof, value, value == top[-1][0]))
    return sorted(found, key=repr)


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.mark.parametrize("block", [7, 4096])
def test_brute_force(spark, block):
    rows = [(i, f"s{i % 3}" if i % 5 else "hot", "en", i, f"Text {i} É") for i in range(600)]
    rows += [(i, None, None, None, None) for i in range(600, 620)] + [(None, "s1", "x", 0, ""), (None, None, None, None, "ABC")]
    rows += [(700 + i, f"single {i}", "en", 1, "One") for i in range(40)]
    rows += [rows[0], rows[0], (1, "s1", "other", 5, "same id"), (900, "", "en", -4, "LONG " * 50_000)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("block", F.lit(1)).withColumn("leaf", F.lit("x"))
    built = merkle.build(frame, merkle.tampered(frame))
    assert rows_of(merkle.prove(built, block=block)) == brute(rows)


def test_some_leaves(spark):
    """Proofs of a few leaves need the nodes beside their paths and nothing else."""
    frame = spark.createDataFrame([(i, f"s{i % 2}", "en", i, str(i)) for i in range(500)], SCHEMA)
    built = merkle.build(frame)
    some = merkle.prove(built, built.leaves.where("doc_id % 50 = 3"))
    assert rows_of(some) == [row for row in rows_of(merkle.prove(built)) if row[0] % 50 == 3]
    assert some.where("NOT verified").isEmpty()


def test_missing_nodes():
    size, known = 1000, np.array([3, 4, 17, 900])
    levels = merkle.missing(known, size)
    assert levels[0].tolist() == [i for i in [*range(32), *range(896, 912)] if i not in known]
    assert levels[1].tolist() == [*range(2, 16), *range(48, 56), *range(57, 63)]
    assert levels[2].tolist() == [1, 2]
    assert merkle.missing(np.arange(1000), 1000)[0].size == 0


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(5, None, None, None, None)], SCHEMA)
    assert rows_of(merkle.digest(one)) == brute([(5, None, None, None, None)])
    nothing = spark.createDataFrame([], SCHEMA)
    assert merkle.build(nothing).root is None
    assert merkle.digest(nothing).count() == 0
