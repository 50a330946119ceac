"""Small verification queries over raw tables and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsift.functions import constants as C
from airsift.operators.daily import trusted_pm25


def _value() -> Column:
    return F.col("value").try_cast("double")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count; every count is a partial aggregate."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("model"), "rows")
        for name, table in tables.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def archive_extent(raw: DataFrame) -> DataFrame:
    """Year range and station count from folder columns only."""
    return raw.agg(
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
        F.count_distinct("locationid").alias("station_count"),
    )


def readings_by_parameter(raw: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Readings and mean value per parameter, for one month or all of the archive."""
    if year is not None:
        raw = raw.where(F.col("year") == f"{year:04d}")
    if month is not None:
        raw = raw.where(F.col("month") == f"{month:02d}")
    return (
        raw.groupBy("parameter")
        .agg(F.count(F.lit(1)).alias("cnt"), F.round(F.avg(_value()), 2).alias("avg_value"))
        .orderBy(F.desc("cnt"))
    )


def weather_coverage(weather: DataFrame, limit: int = 5) -> DataFrame:
    """Hourly rows and date range of the first stations in id order."""
    return (
        weather.groupBy("location_id")
        .agg(
            F.count(F.lit(1)).alias("hourly_rows"),
            F.min("date").alias("earliest"),
            F.max("date").alias("latest"),
        )
        .orderBy("location_id")
        .limit(limit)
    )


def stream_recency(readings: DataFrame) -> DataFrame:
    return readings.agg(
        F.count(F.lit(1)).alias("stream_rows"),
        F.min("datetime").alias("earliest"),
        F.max("datetime").alias("latest"),
    )


def sentinel_rows(raw: DataFrame) -> DataFrame:
    return raw.where(_value() == F.lit(C.SENTINEL)).agg(F.count(F.lit(1)).alias("sentinel_rows"))


def parameters_present(raw: DataFrame) -> DataFrame:
    return raw.select("parameter").distinct().orderBy("parameter")


def parameter_month(raw: DataFrame, parameter: str, year: int, month: int) -> DataFrame:
    chosen = raw.where(
        (F.col("year") == f"{year:04d}") & (F.col("month") == f"{month:02d}") & (F.col("parameter") == parameter)
    )
    return chosen.agg(F.count(F.lit(1)).alias("cnt"), F.avg(_value()).alias("avg_value"))


def city_plausibility(daily_aqi: DataFrame, daily_aq: DataFrame) -> DataFrame:
    pm25 = trusted_pm25(daily_aq).select("location_id", "measurement_date", "avg_value")
    return (
        daily_aqi.join(pm25, ["location_id", "measurement_date"])
        .groupBy("city")
        .agg(
            F.round(F.avg("avg_value"), 1).alias("mean_pm25"),
            F.round(F.avg("composite_aqi"), 0).alias("mean_composite_aqi"),
        )
    )


def city_hours(diurnal: DataFrame, city: str) -> DataFrame:
    return (
        diurnal.where((F.col("parameter") == "pm25") & (F.col("city") == city))
        .groupBy("day_type", "hour_of_day")
        .agg(F.round(F.avg("avg_value"), 1).alias("avg_pm25"))
        .orderBy("day_type", "hour_of_day")
    )


def forecast_listing(forecasts: DataFrame) -> DataFrame:
    return forecasts.select(
        "location_name",
        "forecast_date",
        F.round("forecast_pm25", 1).alias("pm25_fcst"),
        F.round("ci_lower_95", 1).alias("ci_low"),
        F.round("ci_upper_95", 1).alias("ci_high"),
    ).orderBy("location_name", "forecast_date")
