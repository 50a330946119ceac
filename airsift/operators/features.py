"""Lagged features per station-day and their quality statistics.

Windows run per station over daily rows: one row per day of the station's history,
so a window partition is bounded by the number of days however many raw readings
the station has.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airsift.functions import calendar, stats

LAGS = [1, 7, 30]
TRAILING_MEANS = [7, 30]


def mart_lagged_features(aq_weather: DataFrame, holidays: DataFrame) -> DataFrame:
    """Station x date: lags, trailing means, calendar, weather and the next day's target.

    Lags count rows, not calendar days. All window expressions share one partitioning
    and order, hence one shuffle and one sort.
    """
    series = Window.partitionBy("location_id").orderBy("measurement_date")
    day = F.col("measurement_date")
    pm25 = F.col("avg_pm25")
    lags = {f"pm25_lag{n}": F.round(F.lag(pm25, n).over(series), 4) for n in LAGS}
    means = {
        f"pm25_roll{n}": F.round(F.avg(pm25).over(series.rowsBetween(-(n - 1), 0)), 4)
        for n in TRAILING_MEANS
    }
    rows = (
        aq_weather.where(pm25.isNotNull())
        .select(
            "location_id", "location_name", "city", "province", "sensor_type", "measurement_date",
            "avg_pm25", "corrected_pm25", "avg_rh_2m", "avg_wind_speed", "total_precipitation_mm",
            "inversion_risk", "wet_scavenging",
        )
        .withColumns({**lags, **means, "pm25_next1": F.round(F.lead(pm25, 1).over(series), 4)})
        .withColumns(
            {
                "month_sin": F.round(F.sin(calendar.month_angle(day)), 6),
                "month_cos": F.round(F.cos(calendar.month_angle(day)), 6),
                "day_of_week": calendar.iso_weekday(day),
                "is_weekend": calendar.is_weekend(day).cast("int"),
            }
        )
    )
    return flag_holidays(rows, holidays)


def flag_holidays(rows: DataFrame, holidays: DataFrame) -> DataFrame:
    """0/1 holiday flags from ``(holiday_date, is_tet_period)``."""
    calendar_rows = holidays.select(
        F.col("holiday_date").alias("measurement_date"),
        F.lit(1).alias("matched"),
        F.col("is_tet_period").alias("tet"),
    )
    return (
        rows.join(calendar_rows, "measurement_date", "left")
        .withColumn("is_holiday", F.coalesce("matched", F.lit(0)))
        .withColumn("is_tet_period", F.coalesce("tet", F.lit(0)))
        .drop("matched", "tet")
    )


def lagged_features_since(aq_weather: DataFrame, stored: DataFrame, holidays: DataFrame, first_day: dt.date) -> DataFrame:
    """The rows of ``mart_lagged_features`` that change when ``aq_weather`` does from ``first_day`` on; whole months.

    ``stored`` is the table before. Carried in are each station's last rows before ``first_day``, as many as the longest
    lag counts, found by a top-n that tasks apply before the shuffle. The row before the seam has a new next day: the
    stored months that hold such rows, one a station, are returned too, with ``pm25_next1`` replaced. Between the seams and
    ``first_day`` there may be months without rows. Rows before ``first_day`` keep the holidays they were built with.
    """
    first = F.lit(first_day)
    usable = aq_weather.where(F.col("avg_pm25").isNotNull())
    latest_first = Window.partitionBy("location_id").orderBy(F.desc("measurement_date"))
    earlier = usable.where(F.col("measurement_date") < first)
    carried = earlier.withColumn("_back", F.row_number().over(latest_first)).where(F.col("_back") <= max(*LAGS, *TRAILING_MEANS))
    rows = carried.drop("_back").unionByName(usable.where(F.col("measurement_date") >= first))
    fresh = mart_lagged_features(rows, holidays).where(F.col("measurement_date") >= first)

    seams = carried.where("_back = 1").select("location_id", F.col("measurement_date").alias("seam_date"))
    next_days = usable.where(F.col("measurement_date") >= first).groupBy("location_id").agg(F.min_by("avg_pm25", "measurement_date").alias("next_value"))
    replaced = seams.join(next_days, "location_id", "left").select("location_id", "seam_date", F.round("next_value", 4).alias("next_value"))
    months = seams.select(F.trunc("seam_date", "MM").alias("seam_month")).distinct()
    before = stored.where(F.col("measurement_date") < first).withColumn("seam_month", F.trunc("measurement_date", "MM")).join(months, "seam_month", "left_semi").drop("seam_month")
    at_seam = F.col("measurement_date") == F.col("seam_date")
    corrected = before.join(replaced, "location_id", "left").withColumn("pm25_next1", F.when(at_seam, F.col("next_value")).otherwise(F.col("pm25_next1")))
    return fresh.unionByName(corrected.select(*fresh.columns))


# Output suffix -> feature column, against the current day and against the next day.
CORRELATED_WITH_TODAY = {
    "lag1": "pm25_lag1", "lag7": "pm25_lag7", "lag30": "pm25_lag30",
    "roll7": "pm25_roll7", "roll30": "pm25_roll30",
    "month_sin": "month_sin", "month_cos": "month_cos",
    "dow": "day_of_week", "weekend": "is_weekend", "holiday": "is_holiday", "tet": "is_tet_period",
    "rh": "avg_rh_2m", "wind": "avg_wind_speed", "precip": "total_precipitation_mm",
    "inv": "inversion_risk",
}
CORRELATED_WITH_NEXT = {
    "lag1": "pm25_lag1", "roll7": "pm25_roll7", "rh": "avg_rh_2m",
    "wind": "avg_wind_speed", "precip": "total_precipitation_mm", "inv": "inversion_risk",
}
COUNTED_NULLS = {
    "pm25_lag1": "pm25_lag1", "pm25_lag7": "pm25_lag7", "pm25_lag30": "pm25_lag30",
    "pm25_roll7": "pm25_roll7", "pm25_roll30": "pm25_roll30",
    "rh": "avg_rh_2m", "wind_speed": "avg_wind_speed", "precip": "total_precipitation_mm",
    "inversion_risk": "inversion_risk",
}


def mart_feature_stats(features: DataFrame) -> DataFrame:
    """One row per station: null counts, correlations and the PM2.5 distribution."""

    def correlation(name: str, target: str):
        return F.round(stats.safe_corr(F.col(name).cast("double"), F.col(target)), 4)

    pm25 = F.col("avg_pm25")
    return features.groupBy("location_id", "city", "location_name").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(pm25).alias("non_null_pm25"),
        F.count("pm25_next1").alias("non_null_target"),
        *[stats.null_count(F.col(name)).alias(f"{key}_nulls") for key, name in COUNTED_NULLS.items()],
        *[
            correlation(name, "avg_pm25").alias(f"corr_{key}_pm25")
            for key, name in CORRELATED_WITH_TODAY.items()
        ],
        *[
            correlation(name, "pm25_next1").alias(f"corr_{key}_next")
            for key, name in CORRELATED_WITH_NEXT.items()
        ],
        F.round(F.avg(pm25), 2).alias("mean_pm25"),
        F.round(stats.percentile(pm25, 0.5, exact=True), 2).alias("median_pm25"),
        F.round(F.stddev_samp(pm25), 2).alias("stddev_pm25"),
        F.round(F.min(pm25), 2).alias("min_pm25"),
        F.round(F.max(pm25), 2).alias("max_pm25"),
        F.min("measurement_date").alias("series_start"),
        F.max("measurement_date").alias("series_end"),
    )
