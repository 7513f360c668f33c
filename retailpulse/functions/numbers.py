"""Rounding that gives the same digits on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` in double arithmetic."""
    scale = F.lit(float(10**digits))
    return F.floor(value.cast("double") * scale + F.lit(0.5)) / scale


def exact_mean(value: Column) -> Column:
    """Mean of a decimal from its exact sum: the same whatever the row order."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def blank_as_zero(value: Column) -> Column:
    """BLANK counts as 0 inside differences and comparisons."""
    return F.coalesce(value, F.lit(0))


def zero_as_blank(count: Column) -> Column:
    """A count over no rows is BLANK, not 0."""
    return F.nullif(count, F.lit(0))
