"""Exact sums of doubles of any size, as two decimals per power of 10 ** 12.

A double is a number of about 17 digits times a power of ten, as the JVM writes it. It is placed at the power of 10 ** 12 at or
below its last digit and split there at 10 ** 18. The parts of equal place add up as decimals, which a
grouped sum does before the shuffle; doubles have fewer than 60 places. The sums of a group are then
carried from place to place, divided by the number of values from the top down, and written as text.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits of a place, and of the lower part of a value.
PLACE, LOW = 12, 18
# Sums of 10 ** 12 values fit.
PART = "decimal(20,0)"
WIDE = "decimal(38,0)"


def _wide(number: int) -> Column:
    return F.lit(Decimal(number)).cast(WIDE)


def place_of(value: Column) -> tuple[Column, Column, Column]:
    """(place, low, high): ``value`` is ``(low + high * 10**18) * 10**(12 * place)``."""
    text = value.cast("string")
    fraction = F.regexp_extract(text, r"\.([0-9]+)", 1)
    exponent = F.coalesce(F.nullif(F.regexp_extract(text, r"E(-?[0-9]+)$", 1), F.lit("")).cast("int"), F.lit(0))
    scale = exponent - F.length(fraction)
    place = F.floor(scale / PLACE).cast("int")
    digits = F.concat(F.regexp_extract(text, r"^(-?[0-9]+)", 1), fraction).cast(PART)
    shifted = (digits * F.rpad(F.lit("1"), scale - PLACE * place + 1, F.lit("0")).cast("decimal(13,0)")).cast(WIDE)
    low = (shifted % _wide(10**LOW)).cast(WIDE)
    return place, low.cast(PART), ((shifted - low) / _wide(10**LOW)).cast(PART)


def _carried(parts: Column, sign: int) -> Column:
    """struct(rest, limbs): the sum of ``parts`` in limbs below 10 ** 12, lowest first, from place -1 or lower on; ``rest`` is -1 for a negative sum."""
    places = F.transform(parts, lambda p: p["place"])
    lowest, highest = F.least(F.array_min(places), F.lit(-1)), F.greatest(F.array_max(places), F.lit(0))
    zero = _wide(0)

    def limb(q: Column) -> Column:
        # The upper part of a place below counts 10 ** 18 / 10 ** 12 here.
        def share(p: Column) -> Column:
            upper = (p["high"] * F.lit(Decimal(10 ** (LOW - PLACE))).cast("decimal(7,0)")).cast(WIDE)
            return F.when(p["place"] == q, p["low"]).when(p["place"] + 1 == q, upper).otherwise(zero)

        return F.aggregate(parts, zero, lambda total, p: (total + sign * share(p)).cast(WIDE))

    def step(state: Column, value: Column) -> Column:
        total = (state["rest"] + value).cast(WIDE)
        digit = F.pmod(total, _wide(10**PLACE)).cast(WIDE)
        rest = ((total - digit) / _wide(10**PLACE)).cast(WIDE)
        return F.struct(rest.alias("rest"), F.concat(state["limbs"], F.array(digit.cast("bigint"))).alias("limbs"))

    limbs = F.transform(F.sequence(lowest, highest + 4), limb)
    start = F.struct(zero.alias("rest"), F.array().cast("array<bigint>").alias("limbs"))
    return F.aggregate(limbs, start, step)


def mean_text(parts: Column, n: Column) -> Column:
    """The mean of ``n`` values with sums ``parts`` (place, low, high) as text with two decimals, halves rounded away from zero."""
    plain, negated = _carried(parts, 1), _carried(parts, -1)
    negative = plain["rest"] < 0
    # Below place -1 nothing can turn a half into less.
    limbs = F.reverse(F.when(negative, negated["limbs"]).otherwise(plain["limbs"]))
    below = F.greatest(-F.array_min(F.transform(parts, lambda p: p["place"])) - 1, F.lit(0))
    upper = F.slice(limbs, F.lit(1), F.size(limbs) - below)

    def divide(state: Column, limb: Column) -> Column:
        total = (state["rest"] * _wide(10**PLACE) + limb).cast(WIDE)
        rest = F.pmod(total, n.cast(WIDE)).cast(WIDE)
        quotient = ((total - rest) / n.cast(WIDE)).cast("bigint")
        return F.struct(rest.alias("rest"), F.concat(state["limbs"], F.array(quotient)).alias("limbs"))

    start = F.struct(_wide(0).alias("rest"), F.array().cast("array<bigint>").alias("limbs"))
    quotient = F.aggregate(upper, start, divide)["limbs"]

    def round_up(state: Column, limb: Column) -> Column:
        total = limb + state["rest"]
        return F.struct(F.floor(total / 10**PLACE).cast("bigint").alias("rest"), F.concat(F.array(F.pmod(total, F.lit(10**PLACE))), state["limbs"]).alias("limbs"))

    # Half a cent in units of the last place.
    start = F.struct(F.lit(5 * 10 ** (PLACE - 3)).cast("bigint").alias("rest"), F.array().cast("array<bigint>").alias("limbs"))
    rounded = F.aggregate(F.reverse(quotient), start, round_up)["limbs"]
    digits = F.array_join(F.transform(rounded, lambda limb: F.lpad(limb.cast("string"), PLACE, "0")), "")
    whole = F.ltrim(F.left(digits, F.length(digits) - PLACE), F.lit("0"))
    text = F.concat(F.when(whole == "", "0").otherwise(whole), F.lit("."), F.substr(digits, F.length(digits) - (PLACE - 1), F.lit(2)))
    return F.when(negative & ~text.rlike(r"^[0.]+$"), F.concat(F.lit("-"), text)).otherwise(text)
