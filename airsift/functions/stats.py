"""Aggregate expressions; all of them combine partial results before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rank error of percentile sketches over raw rows is 1/accuracy.
PERCENTILE_ACCURACY = 10_000
# With this accuracy nothing is compressed below half a billion rows of a group: for
# groups of daily rows the result is the exact discrete percentile.
EXACT_ACCURACY = 1_000_000_000


def rate_percent(condition: Column, digits: int = 1) -> Column:
    """Share of rows meeting the condition, in percent."""
    return F.round(F.lit(100.0) * F.count_if(condition) / F.count(F.lit(1)), digits)


def percentile(value: Column, share: float, accuracy: int = PERCENTILE_ACCURACY, exact: bool = False) -> Column:
    """Discrete percentile: a mergeable sketch of bounded size, or all of the group's values if ``exact``.

    Choose ``exact`` where groups hold daily rows; raw readings of a station are too many for it.
    """
    return F.percentile_approx(value, F.lit(share), F.lit(EXACT_ACCURACY if exact else accuracy))


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs, NULL when either side is constant."""
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)


def null_count(value: Column) -> Column:
    return F.count(F.lit(1)) - F.count(value)


def settled_round(value: Column, digits: int) -> Column:
    """Round a mean the same way whatever order its terms were added in.

    The order of additions leaves noise in the last binary digits, which would decide
    ties; the inner rounding removes it.
    """
    return F.round(F.round(value, 9), digits)
