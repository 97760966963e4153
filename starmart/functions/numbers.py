"""Exact means: sums stay integral, so results do not depend on the order of partitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCORE_UNITS = 10000


def score_units(score: Column) -> Column:
    """A four-decimal score as a whole number of ten-thousandths."""
    return F.round(score * F.lit(SCORE_UNITS)).cast("bigint")


def mean(total: Column, count: Column, units: int = 1) -> Column:
    """total / (count * units) as a double; NULL when nothing was counted."""
    return F.when(count > 0, total.cast("double") / (count * F.lit(units)).cast("double"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def half_up_tenth(total: Column, count: Column, units: int = 1) -> Column:
    """The mean total / (count * units) rounded half away from zero to one decimal.

    There is no division before the rounding: a decimal division would already round once.
    """
    twice = F.lit(2 * units)
    tenths = _div(F.abs(total) * F.lit(20) + count * F.lit(units),
                  F.nullif(count * twice, F.lit(0).cast("bigint")))
    return F.sign(total).cast("double") * tenths.cast("double") / F.lit(10.0)
