"""Calendar expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from airsift.functions import constants as C

LOCAL_OFFSET_HOURS = 7


def season(day: Column) -> Column:
    month = F.month(day)
    (first_label, first_months), *rest = C.SEASONS
    result = F.when(month.isin(first_months), F.lit(first_label))
    for label, months in rest:
        result = result.when(month.isin(months), F.lit(label))
    return result.otherwise(F.lit(C.OTHER_SEASON))


def iso_weekday(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(day) + F.lit(1)


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def day_type(day: Column) -> Column:
    return F.when(is_weekend(day), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def local_time(instant: Column, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """Wall-clock time at a fixed offset from UTC."""
    return instant + F.make_interval(hours=F.lit(offset_hours))


def month_angle(day: Column) -> Column:
    return F.lit(2.0 * math.pi) * F.month(day) / F.lit(12.0)
