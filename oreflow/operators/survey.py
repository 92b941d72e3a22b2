"""Salary survey: conditional counts and per-country statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions.exact import mean_text, place_of
from oreflow.functions.numbers import annual_salary, has_salary, saturating_int, saturating_long


# Salaries below this are summed exactly; larger ones as doubles.
EXACT_BELOW = 1e18


def total_valid(survey: DataFrame) -> DataFrame:
    """Number of answers with a salary."""
    return survey.agg(F.count_if(has_salary(F.col("salary"))).alias("n"))


def country_counts(survey: DataFrame) -> DataFrame:
    """Answers with a salary per country, countries without one left out."""
    return (
        survey.filter(has_salary(F.col("salary")))
        .groupBy("country")
        .agg(F.count("*").alias("n"))
        .orderBy("country")
    )


def count_report(survey: DataFrame) -> DataFrame:
    """The total first, then one row per country in order.

    Both come out of one pass: the total is the sum of the per-country counts.
    """
    valid = survey.filter(has_salary(F.col("salary")))
    rolled = valid.rollup("country").agg(F.count("*").alias("n"), F.grouping("country").alias("is_total"))
    return (
        rolled.orderBy(F.desc("is_total"), "country")
        .select(F.when(F.col("is_total") == 1, "Total").otherwise(F.col("country")).alias("country"), "n")
    )


def _yearly(survey: DataFrame) -> DataFrame:
    """(country, yearly) of the answers whose salary is a finite number."""
    return (
        survey.filter(has_salary(F.col("salary"), ignore_case=True))
        .select("country", annual_salary(F.col("salary"), F.col("salary_type")).alias("yearly"))
        .filter(F.col("yearly").isNotNull())
    )


def exact_means(survey: DataFrame) -> DataFrame:
    """Count and mean yearly salary per country, exact for salaries of any size.

    ``mean_salary`` is text with two decimals, rounded half up, and never null. Sums are kept per
    power of 10 ** 12 that salaries reach, so the shuffle moves a few rows per country and task.
    """
    place, low, high = place_of(F.col("yearly"))
    parts = _yearly(survey).select("country", place.alias("place"), low.alias("low"), high.alias("high"))
    sums = parts.groupBy("country", "place").agg(F.count("*").alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high"))
    merged = sums.groupBy("country").agg(F.sum("n").alias("n"), F.collect_list(F.struct("place", "low", "high")).alias("parts"))
    return merged.select("country", "n", mean_text(F.col("parts"), F.col("n")).alias("mean_salary")).orderBy("country")


def salary_stats(survey: DataFrame, saturate: bool = True) -> DataFrame:
    """Count, minimum, maximum and mean yearly salary per country.

    ``mean_salary`` is an exact decimal rounded half up to cents; it is null where a
    salary has 19 digits or more or the sum has more than 28; :func:`exact_means` has
    those, too. ``mean_double`` is there for salaries of any size. Minimum and maximum are whole numbers, clamped to 32 bits,
    or to 64 if ``saturate`` is off. Texts that are no finite number are left out.
    """
    whole = saturating_int if saturate else saturating_long
    exact = F.abs("yearly") < EXACT_BELOW
    grouped = _yearly(survey).groupBy("country").agg(
        F.count("*").alias("n"),
        F.min("yearly").alias("lowest"),
        F.max("yearly").alias("highest"),
        F.try_sum(F.when(exact, F.col("yearly").cast("decimal(38,10)"))).alias("total"),
        F.sum(F.when(~exact, F.col("yearly"))).alias("large"),
        F.count_if(exact).alias("n_exact"),
        F.sum("yearly").alias("rough"),
    )
    return grouped.select(
        "country",
        "n",
        whole(F.col("lowest")).alias("min_salary"),
        whole(F.col("highest")).alias("max_salary"),
        F.when(F.col("n_exact") == F.col("n"), F.round(F.col("total") / F.col("n"), 2)).alias("mean_salary"),
        (
            F.when(F.col("total").isNull() & (F.col("n_exact") > 0), F.col("rough")).otherwise(
                F.coalesce(F.col("total").cast("double"), F.lit(0.0)) + F.coalesce("large", F.lit(0.0))
            )
            / F.col("n")
        ).alias("mean_double"),
    ).orderBy("country")
