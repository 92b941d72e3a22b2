"""Short messages: a uniform sample and its hot hashtags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions.priority import priority
from oreflow.functions.text import hashtags, utf16_length

# Size of the sample and number of tags reported.
SAMPLE_SIZE = 100
HOT_TAGS = 5
SEED = 42


def tag_arrivals(messages: DataFrame) -> DataFrame:
    """(id, position, tag): the hashtags of each message in order, positions from 1."""
    tags = messages.select("id", F.posexplode(hashtags(F.col("text"))).alias("place", "tag"))
    return tags.select("id", (F.col("place") + 1).alias("position"), "tag")


def bottom_k(messages: DataFrame, k: int = SAMPLE_SIZE, seed: int = SEED) -> DataFrame:
    """A uniform sample without replacement: the ``k`` lowest hashed priorities.

    Samples of parts combine into the sample of the whole, in any order. Every task
    keeps its own ``k`` rows, so nothing larger than that moves.
    """
    ranked = messages.withColumn("priority", priority(seed, F.col("id")))
    return ranked.orderBy("priority", "id").limit(k)


def tag_counts(sample: DataFrame) -> DataFrame:
    """Occurrences of each hashtag."""
    return tag_arrivals(sample).groupBy("tag").agg(F.count("*").alias("n"))


def hot_tags(sample: DataFrame, n: int = HOT_TAGS) -> DataFrame:
    """The ``n`` most frequent hashtags, ties in tag order."""
    return tag_counts(sample).orderBy(F.desc("n"), "tag").limit(n)


def mean_length(sample: DataFrame) -> DataFrame:
    """Mean message length."""
    return sample.agg(F.avg(utf16_length(F.col("text"))).alias("mean_length"))


def sample_report(sample: DataFrame, seen: int, n: int = HOT_TAGS) -> DataFrame:
    """One row: messages seen, hot tags as ``tag:count`` in order, mean length.

    ``sample`` is at most the sample size, so its few tags may be gathered.
    """
    top = hot_tags(sample, n).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("rank"), "tag"))).alias("top")
    )
    listed = F.transform("top", lambda t: F.concat(t["tag"], F.lit(":"), (-t["rank"]).cast("string")))
    return top.select(
        F.lit(seen).cast("bigint").alias("seen"),
        F.array_join(listed, ",").alias("hot_tags"),
        mean_length(sample).scalar().alias("mean_length"),
    )
