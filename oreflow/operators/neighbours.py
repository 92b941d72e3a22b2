"""User-based rating prediction: statistics, neighbour weights and the fallback cascade."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.operators.skew import MIN_ROWS, hot_keys, salted_join
from oreflow.session import grouped_by, materialise

# A user above this many ratings is heavy; a neighbour shares more than this
# many items and is more similar than this; the answer when nothing is known.
HEAVY_OVER = 20
OVERLAP_OVER = 12
COSINE_OVER = 0.5
UNKNOWN_RATING = 2.5

# Shared items that the look-up of candidates asks for; more of them look up more items
# per user and leave fewer candidates to compare. As few as the first where items have more raters than the third.
PROBE_HITS, SURE_HITS, POPULAR = 3, 5, 4096
# Raters of an item that one row of the index holds, on average at most, and pairs met that one task counts.
POSTINGS, MET_ROWS = 65_536, 2_000_000


def pair_sums(train: DataFrame) -> DataFrame:
    """One row per (user, item); of repeated rows the highest rating counts, sums cover all."""
    return train.groupBy("user", "item").agg(
        F.max("rating").alias("rating"),
        F.count("*").alias("n"),
        F.sum("rating").alias("total"),
        F.sum(F.col("rating") * F.col("rating")).alias("squares"),
    )


def user_statistics(pairs: DataFrame, heavy_over: int = HEAVY_OVER) -> DataFrame:
    """Mean, norm and number of ratings of each user of ``pair_sums``."""
    return pairs.groupBy("user").agg(
        (F.sum("total") / F.sum("n")).alias("user_mean"),
        F.sqrt(F.sum("squares")).alias("norm"),
        F.sum("n").alias("ratings"),
        F.count("*").alias("items"),
        (F.sum("n") > heavy_over).alias("heavy"),
        F.max(F.abs("rating")).alias("highest"),
    )


def item_statistics(pairs: DataFrame) -> DataFrame:
    """Mean rating and number of raters of each item of ``pair_sums``."""
    return pairs.groupBy("item").agg((F.sum("total") / F.sum("n")).alias("item_mean"), F.count("*").alias("raters"))


class RatingTables:
    """Training ratings, one row per (user, item), with user and item statistics.

    Each table is written when it is first asked for, so that every later use reads it.
    """

    def __init__(self, train: DataFrame, heavy_over: int = HEAVY_OVER):
        self._train, self.heavy_over = train, heavy_over

    @cached_property
    def pairs(self) -> DataFrame:
        return materialise(pair_sums(self._train), "pairs")

    @cached_property
    def users(self) -> DataFrame:
        return materialise(user_statistics(self.pairs, self.heavy_over), "users")

    @cached_property
    def items(self) -> DataFrame:
        return materialise(item_statistics(self.pairs), "items")


def rating_tables(train: DataFrame, heavy_over: int = HEAVY_OVER) -> RatingTables:
    """Statistics over all rows; of repeated (user, item) rows the highest rating counts.

    User and item statistics come from partial sums, so a key that holds many rows is
    reduced before the shuffle.
    """
    return RatingTables(train, heavy_over)


def within_reach(tables: RatingTables, overlap_over: int, cosine_over: float) -> DataFrame:
    """The heavy users that can be similar enough to a light one at all.

    A light user has at most ``heavy_over`` items, so the product of both is at most the light norm times the
    heavy user's highest rating times the root of that number. What is left of the cosine must pass the bound,
    which no user with very many ratings can do: those are not indexed.
    """
    heavy = tables.users.filter(F.col("heavy") & (F.col("items") > overlap_over))
    if cosine_over <= 0:
        return heavy
    # A little more than the bound, for rounding.
    reach = F.col("highest") * (math.sqrt(tables.heavy_over) / cosine_over * (1 + 1e-9))
    return heavy.filter(F.col("norm") <= reach)


def candidate_pairs(
    tables: RatingTables, light: DataFrame, heavy: DataFrame, overlap_over: int, min_hot_rows: int = MIN_ROWS
) -> DataFrame:
    """(user, neighbour) of a light and a heavy user that may share more than ``overlap_over`` items.

    Items stand in one order, rarer ones first. Each user, on either side, leaves out its last
    ``overlap_over + 1 - SURE_HITS`` items, and of the next ones popular items as far as ``PROBE_HITS`` allows.
    Of a pair's shared items those left out by the one or the other all lie among the last ones of whichever
    leaves out more of them, so all but that many are met in the index. The items everybody rated pair nobody.
    The index travels as arrays of raters, which are taken apart where a user's pairs are counted.
    """
    needed = overlap_over + 1
    always, at_most = max(0, needed - SURE_HITS), max(0, needed - PROBE_HITS)
    ranked = tables.pairs.select("user", "item").join(tables.items.select("item", "raters"), "item")
    ranked = grouped_by(ranked, tables.pairs.count(), "user")
    # Light users have few items; heavy ones within reach have a norm that bounds their number, too.
    own_items = Window.partitionBy("user")
    left_out = (F.col("from_last") <= always) | ((F.col("from_last") <= at_most) & (F.col("raters") > POPULAR))

    def kept(users: DataFrame) -> DataFrame:
        own = ranked.join(users, "user", "left_semi")
        own = own.withColumn("from_last", F.row_number().over(own_items.orderBy(F.desc("raters"), F.desc("item"))))
        own = own.withColumn("left", F.count_if(left_out).over(own_items))
        return own.filter(~left_out).select("user", "item", "left")

    most = tables.items.agg(F.max("raters")).first()[0] or 0
    part = F.pmod(F.xxhash64("user"), F.lit(-(-most // POSTINGS) or 1)).cast("int")
    postings = kept(heavy).groupBy("item", part.alias("part"), F.col("left").alias("other_left"))
    index = materialise(postings.agg(F.sort_array(F.collect_list("user")).alias("neighbours")), "index")
    probes = materialise(kept(light), "probes")
    sizes = index.groupBy("item").agg(F.sum(F.size("neighbours")).alias("n")).join(probes, "item")
    met_rows = sizes.agg(F.sum("n")).first()[0] or 0

    hot = hot_keys(tables.items, "item", "raters", min_hot_rows)
    met = salted_join(probes, index, "item", hot).drop("item")
    met = met.select("user", "part", F.greatest("left", "other_left").alias("left"), "neighbours")
    schema = T.StructType([T.StructField(name, tables.pairs.schema["user"].dataType) for name in ("user", "neighbour")])
    # At most one row of the index for each item of a light user meets in a group.
    return grouped_by(met, met_rows, "user", "part", task_rows=MET_ROWS).groupBy("user", "part").applyInArrow(_met_enough(needed), schema)


def _met_enough(needed: int) -> Callable[[pa.Table], pa.Table]:
    """(user, neighbour) of the neighbours in a user's arrays that, with the items left out, may share ``needed`` items."""

    def count(met: pa.Table) -> pa.Table:
        lists = met.column("neighbours").combine_chunks()
        found = lists.flatten().dictionary_encode()
        codes, names = found.indices.to_numpy(), found.dictionary
        left = np.zeros(len(names), dtype=np.int64)
        np.maximum.at(left, codes, np.repeat(met.column("left").to_numpy(), np.diff(lists.offsets.to_numpy())))
        enough = np.flatnonzero(np.bincount(codes, minlength=len(names)) + left >= needed)
        user = met.column("user").combine_chunks().take(pa.array(np.zeros(len(enough), dtype=np.int64)))
        return pa.table({"user": user, "neighbour": names.take(pa.array(enough))})

    return count


def neighbour_weights(
    tables: RatingTables,
    active: DataFrame | None = None,
    overlap_over: int = OVERLAP_OVER,
    cosine_over: float = COSINE_OVER,
    centering: str = "sum",
    min_hot_rows: int = MIN_ROWS,
) -> DataFrame:
    """Similar heavy users of every light user (or of those in ``active``).

    Candidates come from :func:`candidate_pairs` and are compared over all their items.
    """
    if centering not in ("sum", "mean"):
        raise ValueError("centering must be 'sum' or 'mean'")
    light = tables.users.filter(~F.col("heavy") & (F.col("items") > overlap_over)).select("user")
    if active is not None:
        light = light.join(active.select("user"), "user", "left_semi")
    heavy = within_reach(tables, overlap_over, cosine_over).select("user")
    ratings = tables.pairs.select("user", "item", "rating")
    candidates = candidate_pairs(tables, light, heavy, overlap_over, min_hot_rows)
    mine = ratings.join(light, "user", "left_semi")
    others = ratings.join(heavy, "user", "left_semi").select(
        F.col("user").alias("neighbour"), "item", F.col("rating").alias("other_rating")
    )

    n, a, b = F.col("n"), F.col("sum_a"), F.col("sum_b")
    compared = (
        candidates.join(mine, "user")
        .join(others, ["neighbour", "item"])
        .groupBy("user", "neighbour")
        .agg(
            F.count("*").alias("n"),
            F.sum("rating").alias("sum_a"),
            F.sum("other_rating").alias("sum_b"),
            F.sum(F.col("rating") * F.col("other_rating")).alias("sum_ab"),
            F.sum(F.col("rating") * F.col("rating")).alias("sum_aa"),
            F.sum(F.col("other_rating") * F.col("other_rating")).alias("sum_bb"),
        )
        .filter(n > overlap_over)
    )
    norms = tables.users.select("user", "norm")
    similar = (
        compared.join(norms.withColumnRenamed("norm", "norm_a"), "user")
        .join(norms.select(F.col("user").alias("neighbour"), F.col("norm").alias("norm_b")), "neighbour")
        .withColumn("cosine", F.col("sum_ab") / (F.col("norm_a") * F.col("norm_b")))
        .filter(F.col("cosine") > cosine_over)
    )
    # Deviations from c * sum: the products expand to sums, with factor n c^2 - 2 c.
    factor = (n - 2) if centering == "sum" else (-1 / n)
    numerator = F.col("sum_ab") + factor * a * b
    spread = (F.col("sum_aa") + factor * a * a) * (F.col("sum_bb") + factor * b * b)
    return similar.select(
        "user",
        "neighbour",
        n.alias("overlap"),
        "cosine",
        F.coalesce(F.try_divide(numerator, F.sqrt(F.greatest(spread, F.lit(0.0)))), F.lit(0.0)).alias("weight"),
        (b / n).alias("neighbour_mean"),
    )


def classify(tables: RatingTables, test: DataFrame) -> DataFrame:
    """Test rows with all that training knows about them and the rule that applies (1 to 5)."""
    known = tables.pairs.select("user", "item", F.col("rating").alias("known_rating"))
    rule = (
        F.when(F.col("user_mean").isNull() & F.col("item_mean").isNull(), 1)
        .when(F.col("user_mean").isNull(), 2)
        .when(F.col("item_mean").isNull() | F.col("heavy"), 3)
        .when(F.col("known_rating").isNotNull(), 4)
        .otherwise(5)
    )
    return (
        test.select("user", "item")
        .join(tables.users.select("user", "user_mean", "heavy"), "user", "left")
        .join(tables.items, "item", "left")
        .join(known, ["user", "item"], "left")
        .withColumn("rule", rule)
    )


def predict(
    tables: RatingTables,
    test: DataFrame,
    overlap_over: int = OVERLAP_OVER,
    cosine_over: float = COSINE_OVER,
    centering: str = "sum",
    iuf: bool = True,
    clamp: tuple[float, float] | None = None,
    min_hot_rows: int = MIN_ROWS,
) -> DataFrame:
    """One predicted rating per test row: (user, item, rule, prediction)."""
    known = materialise(classify(tables, test), "classified")
    targets = known.filter("rule = 5").select("user", "item").distinct()
    weights = neighbour_weights(
        tables, targets.select("user").distinct(), overlap_over, cosine_over, centering, min_hot_rows
    ).select("user", "neighbour", "weight", "neighbour_mean")

    per_user = targets.groupBy("user").agg(F.count("*").alias("n"))
    hot = hot_keys(per_user, "user", "n", min_hot_rows)
    # Only ratings of items that are asked for can be votes.
    rated = tables.pairs.join(targets.select("item").distinct(), "item", "left_semi").select(
        F.col("user").alias("neighbour"), "item", F.col("rating").alias("other_rating")
    )
    votes = (
        salted_join(targets, weights, "user", hot)
        .join(rated, ["neighbour", "item"])
        .groupBy("user", "item")
        .agg(
            F.sum((F.col("other_rating") - F.col("neighbour_mean")) * F.col("weight")).alias("vote"),
            F.sum(F.abs("weight")).alias("strength"),
        )
    )

    scored = known.join(votes, ["user", "item"], "left")
    n_users = tables.users.count()
    weighted: Column = F.col("user_mean") + F.coalesce(F.try_divide("vote", "strength"), F.lit(0.0))
    if iuf:
        weighted = weighted * (F.ln(F.lit(float(n_users))) - F.ln(F.col("raters").cast("double")))
    prediction = (
        F.when(F.col("rule") == 1, UNKNOWN_RATING)
        .when(F.col("rule") == 2, F.col("item_mean"))
        .when(F.col("rule") == 3, F.col("user_mean"))
        .when(F.col("rule") == 4, F.col("known_rating"))
        .when(F.col("strength").isNull(), (F.col("user_mean") + F.col("item_mean")) / 2)
        .otherwise(weighted)
    )
    if clamp:
        prediction = F.least(F.greatest(prediction, F.lit(float(clamp[0]))), F.lit(float(clamp[1])))
    return scored.select("user", "item", "rule", prediction.alias("prediction"))
