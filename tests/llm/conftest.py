from __future__ import annotations

import pytest

# Rows that every operator on documents must stand: nulls, empty and blank texts, repeats, a long text, other scripts.
LONG = "the quick brown fox jumps over the lazy dog and runs away " * 3000
ODD = [
    (1, "Alpha beta gamma.\nshared line\n\n  Shared LINE \nend", "en"),
    (1, "Alpha beta gamma.\nshared line\n\n  Shared LINE \nend", "en"),
    (1, "another text under the same id", None),
    (2, None, "en"),
    (3, "", None),
    (4, " \t\n\x0b ", "fr"),
    (None, "a text without an id\nshared line", "en"),
    (None, None, None),
    (5, LONG, "en"),
    (6, "Éçà ÜBER ñandú 中文 😀 ½ ²\nshared line\r\n", "de"),
    (7, "one", "en"),
]
# Extra columns whose names operators might use themselves.
CLASHES = ["row", "n_lines", "n_dropped", "version", "pos", "key", "h1", "item", "log_weight", "sample_key", "found", "secrets", "parts", "values"]
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(odd):
    for name in CLASHES:
        odd = odd.withColumn(name, odd["lang"])
    return odd


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(sample):
    return {row["doc_id"]: row["text"] or "" for row in sample.select("doc_id", "text").collect()}
