"""Seasonal and diurnal profiles over the staged readings.

Both exist in two forms: straight from readings, and from stored state. State has a row per month of readings and group,
holding what can be merged: sums, counts, extremes, days, and a quantile sketch. A new month of readings adds its own
rows of state; the profiles over all years are merged from state, and readings of earlier months are not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsift.functions import calendar, stats
from airsift.operators.staging import attach_station, restrict_to_stations

# Size of the quantile sketches in the state. The share of readings below a sketched percentile is off by at most about
# 0.25 percentage points, also after merging; groups of up to this many readings are exact.
SKETCH_SIZE = 2048
# First day of the month (UTC) whose readings a row of state holds.
STATE_MONTH = "state_month"

PROFILE_ATTRIBUTES = ["location_name", "city", "province", "sensor_type", "is_outlier_station"]


def _spread():
    value = F.col("measurement_value")
    return [
        F.round(F.avg(value), 4).alias("avg_value"),
        F.round(F.max(value), 4).alias("max_value"),
        F.round(F.min(value), 4).alias("min_value"),
        F.count(F.lit(1)).alias("reading_count"),
    ]


def mart_monthly_profile(measurements: DataFrame, stations: DataFrame) -> DataFrame:
    """Station x parameter x month of year, all years together.

    The days of a group are gathered as a set rather than counted with DISTINCT: a set
    holds at most 31 days per year, while DISTINCT would build one percentile sketch per
    day before merging them.
    """
    keys = ["location_id", "parameter", "month_of_year"]
    rows = restrict_to_stations(measurements, stations).select(
        "location_id",
        "parameter",
        F.month("measurement_date").alias("month_of_year"),
        # Seasons are whole months, so the label is one value per group.
        calendar.season(F.col("measurement_date")).alias("season"),
        "measurement_date",
        "measurement_value",
    )
    profile = rows.groupBy(*keys, "season").agg(
        *_spread(),
        F.round(stats.percentile(F.col("measurement_value"), 0.95), 4).alias("p95_value"),
        F.size(F.collect_set("measurement_date")).cast("bigint").alias("day_count"),
    )
    return attach_station(profile, stations, PROFILE_ATTRIBUTES)


def mart_diurnal_profile(
    measurements: DataFrame, stations: DataFrame, offset_hours: int = calendar.LOCAL_OFFSET_HOURS
) -> DataFrame:
    """Station x parameter x local hour x day type x season."""
    local = calendar.local_time(F.col("measured_at"), offset_hours)
    rows = restrict_to_stations(measurements, stations).select(
        "location_id",
        "parameter",
        F.hour(local).alias("hour_of_day"),
        calendar.day_type(local.cast("date")).alias("day_type"),
        calendar.season(local.cast("date")).alias("season"),
        "measurement_value",
    )
    keys = ["location_id", "parameter", "hour_of_day", "day_type", "season"]
    profile = rows.groupBy(*keys).agg(*_spread())
    return attach_station(profile, stations, PROFILE_ATTRIBUTES)


def _parts() -> list[Column]:
    value = F.col("measurement_value")
    return [
        F.sum(value).alias("value_sum"),
        F.max(value).alias("value_max"),
        F.min(value).alias("value_min"),
        F.count(F.lit(1)).alias("reading_count"),
    ]


def _merged() -> list[Column]:
    count = F.sum("reading_count")
    return [
        F.round(F.sum("value_sum") / count, 4).alias("avg_value"),
        F.round(F.max("value_max"), 4).alias("max_value"),
        F.round(F.min("value_min"), 4).alias("min_value"),
        count.alias("reading_count"),
    ]


def monthly_state(measurements: DataFrame) -> DataFrame:
    """Station x parameter x month: what a month of readings adds to the seasonal profile.

    Days lie in one month each, so their number is a plain count in the state and a sum over it.
    """
    rows = measurements.select(
        F.trunc("measurement_date", "MM").alias(STATE_MONTH), "location_id", "parameter", "measurement_date", "measurement_value"
    )
    return rows.groupBy(STATE_MONTH, "location_id", "parameter").agg(
        *_parts(),
        F.size(F.collect_set("measurement_date")).cast("bigint").alias("day_count"),
        F.kll_sketch_agg_double("measurement_value", F.lit(SKETCH_SIZE)).alias("sketch"),
    )


def monthly_profile_of(state: DataFrame, stations: DataFrame) -> DataFrame:
    """``mart_monthly_profile`` from stored state; ``p95_value`` is within the sketch's rank error."""
    rows = restrict_to_stations(state, stations).withColumns(
        {"month_of_year": F.month(STATE_MONTH), "season": calendar.season(F.col(STATE_MONTH))}
    )
    merged = F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE))
    profile = rows.groupBy("location_id", "parameter", "month_of_year", "season").agg(
        *_merged(),
        F.round(F.kll_sketch_get_quantile_double(merged, F.lit(0.95)), 4).alias("p95_value"),
        F.sum("day_count").alias("day_count"),
    )
    return attach_station(profile, stations, PROFILE_ATTRIBUTES)


def diurnal_state(measurements: DataFrame, offset_hours: int = calendar.LOCAL_OFFSET_HOURS) -> DataFrame:
    """Month x station x parameter x local hour x day type x season: what a month of readings adds to the diurnal profile.

    Months go by UTC and seasons by local time, so a month's last hours may be of the next season.
    """
    local = calendar.local_time(F.col("measured_at"), offset_hours)
    rows = measurements.select(
        F.trunc("measurement_date", "MM").alias(STATE_MONTH),
        "location_id",
        "parameter",
        F.hour(local).alias("hour_of_day"),
        calendar.day_type(local.cast("date")).alias("day_type"),
        calendar.season(local.cast("date")).alias("season"),
        "measurement_value",
    )
    return rows.groupBy(STATE_MONTH, "location_id", "parameter", "hour_of_day", "day_type", "season").agg(*_parts())


def diurnal_profile_of(state: DataFrame, stations: DataFrame) -> DataFrame:
    """``mart_diurnal_profile`` from stored state."""
    keys = ["location_id", "parameter", "hour_of_day", "day_type", "season"]
    profile = restrict_to_stations(state, stations).groupBy(*keys).agg(*_merged())
    return attach_station(profile, stations, PROFILE_ATTRIBUTES)
