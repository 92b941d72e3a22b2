from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest

from oreflow.operators import layout, survey

ROWS = [
    ("A", "NA", "Monthly"),
    ("A", "na", ""),
    ("A", "0", "Weekly"),
    ("A", "0.0", "Yearly"),
    ("A", "1,000", "MONTHLY"),
    ("A", None, None),
    ("NA", "5", ""),
    ("B, Republic of", "1", "weekly"),
    ("B, Republic of", "1", "Yearly"),
    ("C", "NA", "Yearly"),
    ("D", "9999999999", "Monthly"),
]


@pytest.fixture(scope="module")
def answers(spark):
    return spark.createDataFrame(ROWS, "country string, salary string, salary_type string")


def test_counts(answers):
    assert survey.total_valid(answers).first()["n"] == 7
    counts = [tuple(r) for r in survey.country_counts(answers).collect()]
    assert counts == [("A", 3), ("B, Republic of", 2), ("D", 1), ("NA", 1)]


def test_report_starts_with_the_total(answers):
    rows = [tuple(r) for r in survey.count_report(answers).collect()]
    assert rows[0] == ("Total", 7)
    assert rows[1:] == sorted(rows[1:])
    assert sum(n for _, n in rows[1:]) == 7


def test_statistics(answers):
    got = {r["country"]: tuple(r)[1:5] for r in survey.salary_stats(answers).collect()}
    assert got["A"] == (2, 0, 12000, Decimal("6000.00"))
    assert got["NA"] == (1, 5, 5, Decimal("5.00"))
    assert got["B, Republic of"] == (2, 1, 52, Decimal("26.50"))
    assert got["D"] == (1, 2147483647, 2147483647, Decimal("119999999988.00"))
    assert "C" not in got


def test_statistics_without_clamping(answers):
    got = {r["country"]: r["max_salary"] for r in survey.salary_stats(answers, saturate=False).collect()}
    assert got["D"] == 119999999988


def test_salaries_of_any_size(spark):
    rows = [("Z", s, "Yearly") for s in ("1e40", "1e300", "NaN", "Infinity", "-inf", "1e999")]
    rows += [("Y", "9" * 29, "Monthly"), ("Y", "1", "Yearly"), ("X", "NaN", "Yearly"), ("X", "10", "Yearly")]
    rows += [("W", "554381173721555891238670694864048300000000000000000000000000000000000000000", "")]
    df = spark.createDataFrame(rows, "country string, salary string, salary_type string")
    for saturate, top in ((True, 2147483647), (False, 9223372036854775807)):
        got = {r["country"]: tuple(r)[1:] for r in survey.salary_stats(df, saturate).collect()}
        assert got["Z"] == (2, top, top, None, pytest.approx(5e299))
        assert got["Y"] == (2, 1, top, None, pytest.approx(6e29))
        assert got["X"] == (1, 10, 10, Decimal("10.00"), 10.0)
        assert got["W"] == (1, top, top, None, pytest.approx(5.543811737215559e74))


def test_mean_rounds_half_up(spark):
    df = spark.createDataFrame(
        [("X", s, "Yearly") for s in ("0.01", "0.02")] + [("Y", s, "Yearly") for s in ("1", "1", "2")],
        "country string, salary string, salary_type string",
    )
    got = {r["country"]: r["mean_salary"] for r in survey.salary_stats(df).collect()}
    assert got == {"X": Decimal("0.02"), "Y": Decimal("1.33")}


def test_layouts_keep_all_rows(spark):
    df = spark.range(1000).selectExpr("cast(id % 7 as string) as country", "'1' as salary", "'x' as salary_type")
    df = df.repartition(5)
    assert layout.cap_partitions(df, 2).rdd.getNumPartitions() == 2
    assert layout.cap_partitions(df.coalesce(1), 2).rdd.getNumPartitions() == 1
    rows = layout.profile(df, "country").groupBy("layout").sum("n").collect()
    assert {r[0]: r[1] for r in rows} == {"standard": 1000, "partition": 1000}
    summary = {r["layout"]: r for r in layout.keys_per_layout(df, "country").collect()}
    assert summary["partition"]["split_keys"] == 0
    assert summary["standard"]["split_keys"] == 7
    assert {r["layout"] for r in layout.timings(df).filter("nanoseconds > 0").collect()} == {"standard", "partition"}


def test_one_scan_and_one_exchange_before_the_sort(answers):
    plan = survey.salary_stats(answers)._jdf.queryExecution().toString()
    assert plan.count("Exchange hashpartitioning(country") == 1


def test_exact_means_of_any_size(spark):
    """Equal to decimal arithmetic over the decimal forms that the JVM gives the doubles, whatever their size and sign."""
    rng = random.Random(4)
    rows = []
    for country, powers in (("A", (-3, 12)), ("B", (-300, 300)), ("C", (28, 45)), ("D", (0, 4)), ("E", (17, 24))):
        for _ in range(rng.randint(3, 40)):
            rows.append((country, repr(rng.choice([-1, 1, 1, 1]) * rng.random() * 10.0 ** rng.randint(*powers)), "Yearly"))
    rows += [("F", "1e40", "Yearly"), ("F", "-1e40", "Yearly"), ("F", "0.01", "Yearly"), ("F", "0", "Yearly"), ("G", "-0.005", ""), ("H", "0.005", ""), ("I", "-1", ""), ("I", "1", "")]
    rows += [("J", "9" * 30, "Monthly"), ("J", "NaN", ""), ("K", "999999999999.995", ""), ("L", "1e308", "")]
    df = spark.createDataFrame(rows, "country string, salary string, salary_type string").repartition(4)
    values = {}
    for country, number in survey._yearly(df).selectExpr("country", "CAST(yearly AS STRING)").collect():
        values.setdefault(country, []).append(Decimal(number))
    with localcontext(prec=700):
        expected = {c: (len(v), format((sum(v) / len(v)).quantize(Decimal("0.01"), ROUND_HALF_UP), "f")) for c, v in values.items()}
        expected = {c: (n, "0.00" if text == "-0.00" else text) for c, (n, text) in expected.items()}
    assert {r["country"]: (r["n"], r["mean_salary"]) for r in survey.exact_means(df).collect()} == expected


def test_exact_means_of_nothing(spark):
    assert survey.exact_means(spark.createDataFrame([("A", "NA", "")], "country string, salary string, salary_type string")).count() == 0
