"""Text features: term frequency and TF-IDF."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions.text import split_words
from oreflow.session import materialise

# Hash buckets of the own clustering and of the library clustering.
OWN_BUCKETS = 1 << 20
LIBRARY_BUCKETS = 82


def with_words(documents: DataFrame, text: str = "text") -> DataFrame:
    """Documents with their words; line breaks count as spaces."""
    line = F.replace(F.col(text), F.lit("\n"), F.lit(" "))
    return documents.withColumn("words", split_words(line))


def each_word(worded: DataFrame, key: str) -> DataFrame:
    """(key, word), one row per occurrence.

    The outer form keeps the optimizer from adding a filter that splits every text twice.
    """
    return worded.select(key, F.explode_outer("words").alias("word")).filter(F.col("word").isNotNull())


def term_frequency(documents: DataFrame) -> DataFrame:
    """(doc_id, word, n) on exact words."""
    words = each_word(with_words(documents), "doc_id")
    return words.groupBy("doc_id", "word").agg(F.count("*").alias("n"))


def tf_idf(frequency: DataFrame, n_documents: int) -> DataFrame:
    """``n * ln((N + 1) / (df + 1))`` per (doc_id, word).

    ``frequency`` should be a stored table: it is read once for the document counts
    and once for the weights. A word held by very many documents makes one large
    join key. The counts are stored as well: a join that meets them fresh from their
    aggregation would keep its partitions, and the adaptive join could not split the word.
    """
    documents_with = materialise(frequency.groupBy("word").agg(F.count("*").alias("df")), "document-counts")
    weight = F.ln(F.lit(float(n_documents + 1)) / (F.col("df") + 1))
    return frequency.join(documents_with, "word").select(
        "doc_id", "word", "n", "df", (F.col("n") * weight).alias("tf_idf")
    )


def hashed_vectors(documents: DataFrame, buckets: int, weighting: str = "W") -> DataFrame:
    """Documents with ``words`` and a sparse ``features`` vector.

    ``W`` gives term frequencies, ``T`` weighs them by inverse document frequency.
    """
    if weighting not in ("W", "T"):
        raise ValueError("weighting must be 'W' (term frequency) or 'T' (TF-IDF)")
    worded = with_words(documents)
    output = "features" if weighting == "W" else "tf"
    stages = [HashingTF(inputCol="words", outputCol=output, numFeatures=buckets)]
    if weighting == "T":
        stages.append(IDF(inputCol="tf", outputCol="features"))
    return Pipeline(stages=stages).fit(worded).transform(worded)


def sparse_points(vectors: DataFrame, key: str = "doc_id", column: str = "features") -> DataFrame:
    """Sparse vectors as plain arrays: (key, idx, val)."""
    parts = F.unwrap_udt(F.col(column))
    return vectors.select(key, parts["indices"].alias("idx"), parts["values"].alias("val"))
