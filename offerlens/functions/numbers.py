"""Numeric expressions: gates, ranges, percentages, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plausible yearly salary for amounts published by the source.
SALARY_MIN = 15000
SALARY_MAX = 300000


def safe_double(c: Column) -> Column:
    return c.try_cast("double")


def gate(c: Column, low: float = SALARY_MIN, high: float = SALARY_MAX) -> Column:
    """The value when it lies in [low, high], else NULL."""
    return F.when(c.between(low, high), c)


def prefer_pair(
    a_low: Column, a_high: Column, b_low: Column, b_high: Column, labels: tuple[str, str]
) -> tuple[Column, Column, Column]:
    """(label, low, high) of the first pair with any bound; pairs are never mixed."""
    has_a = F.coalesce(a_low, a_high).isNotNull()
    has_b = F.coalesce(b_low, b_high).isNotNull()
    label = F.when(has_a, F.lit(labels[0])).when(has_b, F.lit(labels[1]))
    return (
        label,
        F.when(has_a, a_low).otherwise(b_low),
        F.when(has_a, a_high).otherwise(b_high),
    )


def midpoint(low: Column, high: Column) -> Column:
    """Middle of a range, or the only bound there is."""
    return F.coalesce((low + high) / 2, low, high)


def ordered_bounds(low: Column, high: Column) -> tuple[Column, Column]:
    """Swap the bounds when both are known, non-zero and the wrong way round."""
    swap = (low != 0) & (high != 0) & (low > high)
    return F.when(swap, high).otherwise(low), F.when(swap, low).otherwise(high)


def round_half_away(c: Column, places: int) -> Column:
    """Half up for non-negative values, computed on the double itself."""
    scale = F.lit(float(10**places))
    return F.floor(c * scale + F.lit(0.5)).cast("double") / scale


def round_half_even(c: Column, places: int) -> Column:
    scale = F.lit(float(10**places))
    return F.rint(c * scale) / scale


def pct(n: Column, total: Column, places: int = 2) -> Column:
    """Percentage of ``total`` on a 0-100 scale, in doubles throughout."""
    return round_half_away(F.lit(100.0) * n / total, places)
