"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.session import grouped_by, spread

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


def survey(spark: SparkSession, folder: str) -> DataFrame:
    """Every order is one answer: the customer's nation and a salary text."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    key = F.col("o_orderkey")
    whole = F.floor("o_totalprice").cast("bigint")
    grouped = F.when(
        whole >= 1000,
        F.concat(
            F.floor(whole / 1000).cast("string"), F.lit(","), F.lpad((whole % 1000).cast("string"), 3, "0")
        ),
    ).otherwise(whole.cast("string"))
    salary = (
        F.when(key % 10 == 0, "NA")
        .when(key % 10 == 1, "0")
        .when(key % 10 == 2, F.lit(None).cast("string"))
        .otherwise(F.concat(grouped, F.when(key % 500 == 3, "000000").otherwise("")))
    )
    kind = (
        F.when(key % 4 == 0, "Monthly").when(key % 4 == 1, "weekly").when(key % 4 == 2, "Yearly").otherwise("NA")
    )
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("country"), salary.alias("salary"), kind.alias("salary_type"))
    )


# Texts of salaries that are far too large or no numbers, by what is left of the order's key.
ANY_SIZE = {5: "9" * 30, 6: "1e40", 7: "NaN", 8: "Infinity", 9: "-Infinity", 10: "n/a"}


def survey_any_size(spark: SparkSession, folder: str) -> DataFrame:
    """The survey with some salaries of any size and some that are no numbers."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    left = F.col("o_orderkey") % 97
    salary = F.floor("o_totalprice").cast("bigint").cast("string")
    for value, text in ANY_SIZE.items():
        salary = F.when(left == value, text).otherwise(salary)
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("country"), salary.alias("salary"), F.lit("Monthly").alias("salary_type"))
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """A customer rates the suppliers it bought from: 1 to 5, averaged per pair."""
    line = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    # Counted from the files' footers: a line has one order.
    n_lines = line.count()
    # Orders are short beside lines, so lines are looked up in them without a sort.
    bought = line.join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
    return grouped_by(bought, n_lines, "o_custkey", "l_suppkey").groupBy(F.col("o_custkey").alias("user"), F.col("l_suppkey").alias("item")).agg(
        F.avg(1 + F.col("l_partkey") % 5).alias("rating")
    )


def _held_out() -> tuple[Column, Column]:
    """New users and items, and a tenth of all pairs."""
    u, i = F.col("user"), F.col("item")
    return (u % 50 == 0) | (i % 25 == 0), (u * 31 + i) % 10 == 0


def ratings_train(all_ratings: DataFrame) -> DataFrame:
    """Ratings of known users and items; a part of the held-out pairs is known, too."""
    new, pair = _held_out()
    return all_ratings.filter(~new & (~pair | ((F.col("user") + F.col("item")) % 7 == 0)))


def ratings_test(all_ratings: DataFrame) -> DataFrame:
    """All ratings held out of training for any reason, and the pairs known all the same."""
    new, pair = _held_out()
    return all_ratings.filter(new | pair)


def basket_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A customer's basket holds the suppliers it bought from; repeats included."""
    line = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("basket_id"), F.col("l_suppkey").alias("item")
    )


def messages(events: DataFrame) -> DataFrame:
    """Every event as a short message with three hashtags, two of them glued together."""
    kind = F.col("event_type")
    text = F.concat(
        F.lit("evt\n#"), kind, F.lit(" #"), kind, F.lit("#u"), F.col("user_id").cast("string")
    )
    return events.select(F.col("event_id").alias("id"), "ts", text.alias("text"))
