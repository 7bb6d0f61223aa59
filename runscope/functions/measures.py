"""Exact averages, rounding and small arithmetic on measures.

An average of doubles depends on the order of the additions, so the last digit
of a rounded mean can change with the partitioning or with a retried task. Here a
value is split into whole millionths plus whole millionths of a
millionth, and the former into a high and a low part; the three are summed as BIGINT, which stays in generated code.
Those sums are associative and are turned into a
mean by integer arithmetic once per group. NaN counts as missing throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_UNIT = 1_000_000
#: Between the high and the low part of whole millionths. A power of two, so that doubles are split exactly.
_LOW = 1 << 24


def present(value: Column | str) -> Column:
    """The value, NULL where it is NaN."""
    value = F.col(value) if isinstance(value, str) else value
    number = value.cast("double")
    return F.when(~F.isnan(number), value)


def whole_millionths(value: Column) -> Column:
    return F.rint(present(value).cast("double") * float(_UNIT)).cast("bigint")


def _millionths(value: Column) -> tuple[Column, Column]:
    """High and low part of the whole millionths."""
    whole = F.rint(value.cast("double") * float(_UNIT))
    high = F.floor(whole / float(_LOW))
    return high, (whole - high.cast("double") * float(_LOW)).cast("bigint")


def _rest(value: Column) -> Column:
    scaled = value.cast("double") * float(_UNIT)
    return F.rint((scaled - F.rint(scaled)) * float(_UNIT)).cast("bigint")


def divide_half_up(numerator: Column, denominator: Column) -> Column:
    """Integer division rounded half away from zero; the denominator is positive."""
    twice = F.abs(numerator) * F.lit(2) + denominator
    quotient = F.call_function("div", twice, denominator * F.lit(2))
    return F.when(numerator < 0, -quotient).otherwise(quotient)


def mean(value: Column | str, digits: int) -> Column:
    """Aggregate: mean of the values present, rounded half up to ``digits``."""
    value = present(value)
    whole = lambda c: c.cast("decimal(38,0)")
    count = F.count(value)
    high, low = _millionths(value)
    millionths = whole(F.sum(high)) * F.lit(_LOW) + F.sum(low)
    total = whole(millionths) * F.lit(_UNIT) + F.sum(_rest(value))
    step = whole(count) * F.lit(10 ** (12 - digits))
    rounded = divide_half_up(whole(total), whole(step))
    return F.when(count > 0, rounded.cast("double") / F.lit(float(10**digits)))


def highest(value: Column | str, digits: int = 4) -> Column:
    return F.round(F.max(present(value)), digits)


def spread(value: Column | str, digits: int = 4) -> Column:
    """Aggregate: sample standard deviation; NULL for a single row, never NaN."""
    return F.round(F.stddev_samp(present(value)), digits)


def gain_percent(new: Column, base: Column) -> Column:
    return F.try_divide(new - base, base) * F.lit(100.0)


def gap_percent(best: Column, found: Column) -> Column:
    return F.try_divide(best - found, best) * F.lit(100.0)


def speed_label(base_trials: Column, trials: Column, base: int = 1) -> Column:
    """``2.4x faster`` / ``0.6x slower`` / ``1.0x``; one decimal, half up.

    ``base`` is the number of the first trial. Trials numbered from 0 are compared as they
    are where both counts are above 0; a hit at trial 0 has no ratio, so the counts are then taken from 1.
    """
    if base == 0:
        either = (base_trials == 0) | (trials == 0)
        base_trials, trials = (F.when(either, c + 1).otherwise(c) for c in (base_trials, trials))
    tenths = divide_half_up(base_trials * F.lit(10), trials)
    text = F.concat(
        F.call_function("div", tenths, F.lit(10)).cast("string"),
        F.lit("."),
        F.pmod(tenths, F.lit(10)).cast("string"),
        F.lit("x"),
    )
    label = (
        F.when(trials < base_trials, F.concat(text, F.lit(" faster")))
        .when(trials > base_trials, F.concat(text, F.lit(" slower")))
        .otherwise(text)
    )
    return F.when((trials > 0) & (base_trials > 0), label)


def lr_band(rate: Column | str, low: float = 0.001, mid: float = 0.01) -> Column:
    rate = F.col(rate) if isinstance(rate, str) else rate
    return F.when(rate < low, "low").when(rate < mid, "medium").otherwise("high")


def bin_of(value: Column, bins: int) -> Column:
    """Index of the equal-width bin of a value in [0, 1]; 1 falls in the last bin."""
    index = F.floor(value * F.lit(float(bins))).cast("int")
    return F.greatest(F.lit(0), F.least(index, F.lit(bins - 1)))
