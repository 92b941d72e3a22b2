"""Quality selection by importance resampling.

Two bags of hashed n-grams, one of labelled good documents and one of all documents, are
generative models of target and raw text. A document's weight is the ratio of its likelihoods,
and the Gumbel top-k trick draws ``k`` documents without replacement in proportion to the weights:
each log-weight gets Gumbel noise, and the ``k`` highest sums win. ``k`` follows from the share of
good documents among the labelled ones.

Tokens are runs of letters and digits (any byte beyond ASCII counts as a letter) and runs of other
visible characters, A-Z lower-cased; n-grams are tokens and pairs of neighbours. The noise is a hash
of id and text, so a repeated row gets the same decision and a retried task repeats its own. A null
or empty text has weight one (log-weight 0). Rows that tie with the k-th are all kept. Labels with
null ids or qualities are left out, and a document with several labels is good only if all say so.
Without labels all documents are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import bounded_batches, free_name
from oreflow.session import materialise

# Buckets of hashed n-grams; bytes of text that are looked at together.
BUCKETS, SEGMENT = 1 << 16, 1 << 19
# Most labelled documents that the target model is fitted on: the ones with the lowest hash of their id.
LABELLED = 50_000
# Standard errors that the estimated share of good documents is raised by, in favour of keeping.
MARGIN = 2.0

_CLASS = np.full(256, 2, dtype=np.uint8)  # 0 white space, 1 letters and digits, 2 other
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = 1
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, dtype=np.uint64))


def token_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every token of the bytes."""
    parts = []
    begin = 0
    while begin < len(raw):
        end = begin + SEGMENT
        if end < len(raw):  # not within a token
            spaces = np.flatnonzero(_CLASS[raw[begin:end]] == 0)
            end = begin + int(spaces[-1]) + 1 if len(spaces) else end
        part = raw[begin:end]
        kind = _CLASS[part]
        starts = np.flatnonzero(np.diff(kind, prepend=np.uint8(255)) != 0)
        lengths = np.diff(starts, append=len(part))
        place = np.arange(len(part)) - np.repeat(starts, lengths)
        hashes = np.add.reduceat((_LOWER[part] + np.uint64(1)) * _POWERS[place & 63], starts) if len(starts) else np.zeros(0, np.uint64)
        hashes = (hashes ^ (lengths.astype(np.uint64) << np.uint64(40)))[kind[starts] != 0]
        parts.append(hashes)
        begin = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def buckets(raw: np.ndarray) -> np.ndarray:
    """The buckets of all n-grams of the bytes."""
    one = token_hashes(raw)
    two = one[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + one[1:] if len(one) > 1 else np.zeros(0, np.uint64)
    both = np.concatenate([one, two])
    both ^= both >> np.uint64(29)
    both *= np.uint64(0xBF58476D1CE4E5B9)
    return (both >> np.uint64(48)).astype(np.int64) % BUCKETS


def _bytes(texts: pa.Array) -> Iterator[np.ndarray]:
    for text in texts:
        yield np.frombuffer(text.as_buffer(), dtype=np.uint8) if text.is_valid else np.zeros(0, dtype=np.uint8)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each bucket in all documents and in the good ones; one row per bucket and task."""
    raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for good, text in zip(batch.column("good").to_pylist(), _bytes(batch.column("text")), strict=True):
            counts = buckets(text)
            np.add.at(raw, counts, 1)
            if good:
                np.add.at(target, counts, 1)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "n_raw", "n_target"])


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> tuple[np.ndarray, float]:
    """(log-ratio of each bucket, share of documents to keep).

    Raw counts cover all documents. The target counts cover good documents among at most
    ``labelled`` labelled ones, which bounds what is broadcast. The driver sees one row per bucket.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("quality"))
        .where("label_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("label_id")
        .agg(F.min("quality").alias("good"))
    )
    sample = marks.orderBy(F.xxhash64("label_id"), "label_id").limit(labelled)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = text.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"), "left").select("text", (F.coalesce("good", F.lit(0)) > 0).alias("good"))
    rows = joined.mapInArrow(_count, "bucket long, n_raw long, n_target long").groupBy("bucket").agg(F.sum("n_raw").alias("r"), F.sum("n_target").alias("t")).collect()
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for row in rows:
        raw[row["bucket"]] += row["r"]
        target[row["bucket"]] += row["t"]
    # The share of good documents among the labelled ones that are there.
    seen = docs.select(F.col("doc_id").cast("long").alias("label_id")).distinct().join(marks, "label_id").agg(F.count("*").alias("n"), F.sum(F.col("good").cast("double")).alias("good")).first()
    if not seen["n"] or not seen["good"]:
        return np.zeros(BUCKETS), 1.0
    share = seen["good"] / seen["n"]
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    return ratio, min(1.0, share + MARGIN * math.sqrt(share * (1 - share) / seen["n"]))


def log_weight(text: Column, ratio: np.ndarray) -> Column:
    """The log-ratio of the text's likelihoods under both models."""

    @F.arrow_udf("double")
    def weigh(texts: pa.Array) -> pa.Array:
        return pa.array([float(ratio[buckets(raw)].sum()) for raw in _bytes(texts)], pa.float64())

    return weigh(text)


def gumbel(*columns: Column, seed: int = 1) -> Column:
    """Standard Gumbel noise from a hash of the columns."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def kth_largest(keys: DataFrame, k: int, few: int = 1000) -> float:
    """The k-th largest value of the only column, by histograms of ever narrower ranges."""
    name = keys.columns[0]
    low, high = keys.agg(F.min(name), F.max(name)).first()
    above = 0  # values above ``high``
    while low < high:
        inside = keys.where(F.col(name).between(low, high))
        n = inside.count()
        if n <= few:
            return sorted((row[0] for row in inside.collect()), reverse=True)[k - above - 1]
        middle = [low + (high - low) * i / 256 for i in range(1, 256)]
        if not low < middle[0] or not middle[-1] < high:  # neighbouring numbers
            top = inside.where(F.col(name) == high).count()
            if k <= above + top:
                return high
            above, high = above + top, math.nextafter(high, -math.inf)
            continue
        bin_ = F.least(F.floor((F.col(name) - low) / ((high - low) / 256)), F.lit(255))
        found = {row["b"]: row for row in inside.groupBy(bin_.alias("b")).agg(F.count("*").alias("n"), F.min(name).alias("low"), F.max(name).alias("high")).collect()}
        for b in sorted(found, reverse=True):
            if k <= above + found[b]["n"]:
                low, high = found[b]["low"], found[b]["high"]
                break
            above += found[b]["n"]
    return high


def score(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, seed: int = 1) -> tuple[DataFrame, str, str, float]:
    """``docs`` written with two more columns, their names (log-weight and key), and the least key that is kept."""
    bounded_batches(docs.sparkSession)
    ratio, share = fit(docs, labels, labelled)
    weight, key = free_name(docs.columns, "log_weight"), free_name(docs.columns, "sample_key")
    weighed = docs.withColumn(weight, log_weight(F.coalesce("text", F.lit("")), ratio))
    keyed = materialise(weighed.withColumn(key, F.col(weight) + gumbel(F.col("doc_id"), F.coalesce("text", F.lit("")), seed=seed)), "weighed")
    k = math.ceil(share * keyed.count())
    return keyed, weight, key, kth_largest(keyed.select(key), k) if 0 < share < 1 and k else -math.inf


def select(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, seed: int = 1) -> DataFrame:
    """The rows of ``docs`` that are drawn, with its columns."""
    keyed, _, key, least = score(docs, labels, labelled, seed)
    return keyed.where(F.col(key) >= least).select(*(F.col(f"`{c}`") for c in docs.columns))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, log_weight, kept) of every row."""
    keyed, weight, key, least = score(docs.select("doc_id", "text"), labels)
    return keyed.select("doc_id", F.round(weight, 6).alias("log_weight"), (F.col(key) >= least).alias("kept"))
