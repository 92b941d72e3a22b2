"""Salary parsing and numeric conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MAX = 2147483647
INT_MIN = -2147483648
LONG_MAX = 9223372036854775807
LONG_MIN = -9223372036854775808

# Texts that stand for a missing salary.
MISSING_SALARY = ("NA", "0")
# Pay periods per year, by lower-case salary type; any other type is yearly.
PERIODS_PER_YEAR = {"monthly": 12, "weekly": 52}


def has_salary(salary: Column, ignore_case: bool = False) -> Column:
    """True where the salary text is neither missing nor one of the sentinels."""
    text = F.upper(salary) if ignore_case else salary
    return F.coalesce(~text.isin(*MISSING_SALARY), F.lit(False))


def annual_salary(salary: Column, salary_type: Column) -> Column:
    """Yearly salary as a double; null where the text is not a finite number or the product is none."""
    amount = F.replace(salary, F.lit(","), F.lit("")).try_cast("double")
    factor = F.lit(1)
    for period, times in PERIODS_PER_YEAR.items():
        factor = F.when(F.lower(salary_type) == period, times).otherwise(factor)
    yearly = amount * factor
    return F.when(~F.isnan(yearly) & (F.abs(yearly) < float("inf")), yearly)


def saturating_int(value: Column) -> Column:
    """Truncate to a 32-bit integer, clamping out-of-range values."""
    return F.least(F.greatest(value, F.lit(INT_MIN)), F.lit(INT_MAX)).cast("int")


def saturating_long(value: Column) -> Column:
    """Truncate to a 64-bit integer, clamping out-of-range values."""
    limit = float(1 << 63)
    return F.when(value >= limit, F.lit(LONG_MAX)).when(value < -limit, F.lit(LONG_MIN)).otherwise(value.cast("bigint"))
