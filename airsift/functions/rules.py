"""Validation rules of the raw zone: one set for the archive, one for live readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airsift.functions import constants as C


def over_pm25_ceiling(parameter: Column, value: Column) -> Column:
    """Implausible PM2.5; other parameters have no ceiling in the archive."""
    return (F.lower(parameter) == "pm25") & (value >= F.lit(C.PM25_CEILING))


def archive_row_accepted(location: Column, instant: Column, parameter: Column, value: Column) -> Column:
    """Keep rule of the archive over already parsed columns (an unreadable cell is NULL).

    A value from 0 up to the parameter's ceiling passes; that leaves out missing values,
    the negative sentinel and NaN, which Spark orders above every number. Two
    comparisons rather than one per rule, because each one parses the text again.
    Parameters without a ceiling are compared with NaN, which every number is below.
    """
    present = location.isNotNull() & instant.isNotNull() & parameter.isNotNull()
    ceiling = F.when(F.lower(parameter) == "pm25", F.lit(C.PM25_CEILING)).otherwise(F.lit(float("nan")))
    return present & (value >= 0) & (value < ceiling)


def known_parameter(parameter: Column) -> Column:
    return parameter.isin(C.KNOWN_STREAM_PARAMETERS)


def rejection_reason(value: Column, parameter: Column) -> Column:
    """First failed rule of a live reading, empty text when it is valid.

    A value that is missing or not a number cannot be judged by the range rules and
    counts as out of range.
    """
    return (
        F.when(value.isNull() | F.isnan(value), F.lit("value_out_of_range"))
        .when(value == F.lit(C.SENTINEL), F.lit("sentinel_value"))
        .when(value < 0, F.lit("negative_value"))
        .when(value >= F.lit(C.PM25_CEILING), F.lit("value_out_of_range"))
        .when((parameter != "") & ~known_parameter(parameter), F.lit("unknown_parameter"))
        .otherwise(F.lit(""))
    )


def parameter_or_unknown(parameter: Column) -> Column:
    return F.coalesce(F.nullif(parameter, F.lit("")), F.lit("unknown"))
