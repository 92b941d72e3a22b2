from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from oreflow.functions import annual_salary, hashtags, jvm_hash, priority, saturating_int, split_words, utf16_length


def evaluate(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_split_words(spark):
    texts = ["", " ", "   ", "a  b", "a b  ", " a", "a\tb", None]
    assert evaluate(spark, texts, split_words) == [
        [""], [], [], ["a", "", "b"], ["a", "b"], ["", "a"], ["a\tb"], None
    ]


def test_hashtags(spark):
    texts = ["#", "##", "##a", "#a#b", "x#a", "a\n#b", "", "#a #a##b# c", "no tags"]
    assert evaluate(spark, texts, hashtags) == [
        [""], [], ["", "a"], ["a", "b"], [], ["b"], [], ["a", "a", "", "b"], []
    ]


def reference_hash(text: str) -> int:
    units = text.encode("utf-16-be")
    h = 0
    for i in range(0, len(units), 2):
        h = (h * 31 + int.from_bytes(units[i : i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def test_jvm_hash(spark):
    rng = random.Random(1)
    alphabet = "abcXYZ019 äöß€漢字😀𝄞_-"
    texts = ["", "a", "polygenelubricants", "Ünï", "😀"] + [
        "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(200)
    ]
    assert evaluate(spark, texts, jvm_hash) == [reference_hash(t) for t in texts]


def test_utf16_length(spark):
    assert evaluate(spark, ["", "abc", "ä€", "a😀"], utf16_length) == [0, 3, 2, 3]


def test_saturating_int(spark):
    values = [1.9, -1.9, 3e9, -3e9, 2147483647.0]
    assert evaluate(spark, values, saturating_int, "double") == [1, -1, 2147483647, -2147483648, 2147483647]


def test_annual_salary(spark):
    rows = [("1,000", "MONTHLY"), ("10", "weekly"), ("5.5", "Yearly"), ("7", None), ("abc", "Monthly"), (None, "x")]
    df = spark.createDataFrame(rows, "salary string, kind string")
    got = [r[0] for r in df.select(annual_salary(F.col("salary"), F.col("kind"))).collect()]
    assert got == [12000.0, 520.0, 5.5, 7.0, None, None]


def test_priority_is_a_fixed_order(spark):
    df = spark.range(5).select("id", priority(1, F.col("id")).alias("p"))
    import hashlib

    for row in df.collect():
        assert row["p"] == hashlib.md5(f"1-{row['id']}".encode()).hexdigest()


@pytest.mark.parametrize("modulus", [64, 59])
def test_remainder_keeps_the_sign(spark, modulus):
    from oreflow.operators.bloom import slot

    values = [-7, 7, -2147483648, 0, -64, -59]
    expected = [abs(v) % modulus for v in values]
    assert evaluate(spark, values, lambda c: slot(c, modulus), "int") == expected
