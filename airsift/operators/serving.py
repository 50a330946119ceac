"""Read queries that serve the marts. ``as_of`` is always given by the caller."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsift.functions import aqi
from airsift.functions import constants as C

MONTHS = list(range(1, 13))
HOURS = list(range(24))


def latest_station_aqi(daily_aqi: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """Newest row of each station within the last days.

    Picking the newest row is a partial aggregate, so each task sends one row per station. The
    date bound prunes row groups; over stored tables ``plans.serve`` also opens only the
    months that can hold it.
    """
    columns = [
        "location_name", "city", "station_lat", "station_lon", "sensor_type", "composite_aqi",
        "health_category", "dominant_pollutant", "pm25_avg", "cigarette_equivalent", "measurement_date",
    ]
    return (
        daily_aqi.where(F.col("measurement_date") >= F.lit(as_of - dt.timedelta(days=days)))
        .groupBy("location_id")
        .agg(F.max_by(F.struct(*columns), "measurement_date").alias("newest"))
        .select("location_id", "newest.*")
        .withColumn("measurement_date", F.col("measurement_date").cast("string"))
        .orderBy("city", "location_name")
    )


def typed_payload(rows: DataFrame, integers: Iterable[str] = (), numbers: Iterable[str] = ()) -> DataFrame:
    """Text columns to numbers: blank or unreadable text becomes NULL."""
    integers, numbers = set(integers), set(numbers)

    def typed(name: str) -> Column:
        text = F.nullif(F.col(name).cast("string"), F.lit(""))
        if name in integers:
            # Through double, so that "3.0" is a whole number too.
            return text.try_cast("double").try_cast("int")
        return text.try_cast("double") if name in numbers else text

    return rows.select(*[typed(name).alias(name) for name in rows.columns])


def _map_row_is_usable() -> Column:
    """Id and position can be read, and so can AQI, PM2.5 and cigarettes unless they are blank."""
    usable = F.col("location_id").try_cast("int").isNotNull()
    for name in ("station_lat", "station_lon"):
        usable = usable & F.col(name).try_cast("double").isNotNull()
    for name, kind in (("composite_aqi", "int"), ("pm25_avg", "double"), ("cigarette_equivalent", "double")):
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        usable = usable & ((text == "") | F.col(name).try_cast(kind).isNotNull())
    return usable


def _with_map_columns(latest: DataFrame) -> DataFrame:
    return latest.select(
        F.col("location_id").try_cast("int").alias("location_id"),
        "location_name",
        "city",
        F.col("station_lat").try_cast("double").alias("lat"),
        F.col("station_lon").try_cast("double").alias("lon"),
        F.col("composite_aqi").try_cast("int").alias("composite_aqi"),
        "health_category",
        "dominant_pollutant",
        "sensor_type",
        F.round(F.col("pm25_avg").try_cast("double"), 1).alias("pm25_avg"),
        F.round(F.col("cigarette_equivalent").try_cast("double"), 1).alias("cigarette_equivalent"),
        F.col("measurement_date").cast("string").alias("measurement_date"),
        aqi.colour(F.col("health_category")).alias("colour"),
        _map_row_is_usable().alias("usable"),
    )


def map_points(latest: DataFrame) -> DataFrame:
    """Typed map rows with their colour; a row with an unreadable cell is skipped."""
    return _with_map_columns(latest).where("usable").drop("usable")


def geojson(latest: DataFrame) -> DataFrame:
    """One row with the map as GeoJSON text, features by city, name and id.

    The answer is one document, so its features come together in one row; the input is
    one row per allowlisted station, never readings.
    """
    properties = [
        "location_id", "location_name", "city", "composite_aqi", "health_category",
        "dominant_pollutant", "sensor_type", "pm25_avg", "cigarette_equivalent",
        "measurement_date", "colour",
    ]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"),
        F.struct(*properties).alias("properties"),
    )
    placed = F.struct(F.col("city"), F.col("location_name"), F.col("location_id"), feature.alias("feature"))
    # collect_list leaves NULLs out; skipped rows still count for updated_at.
    features = F.array_sort(F.collect_list(F.when(F.col("usable"), placed)))
    document = F.struct(
        F.lit("FeatureCollection").alias("type"),
        F.coalesce(F.max("measurement_date"), F.lit("")).alias("updated_at"),
        F.transform(features, lambda row: row["feature"]).alias("features"),
    )
    text = F.to_json(document, {"ignoreNullFields": "false"})
    return _with_map_columns(latest).agg(text.alias("geojson"))


def analytics_health(health: DataFrame) -> DataFrame:
    return health.select(
        "city", "year", "who_compliance_pct", "avg_pm25", "avg_cigarette_equivalent",
        "good_days", "moderate_days", "usg_days", "unhealthy_days", "very_unhealthy_days",
        "hazardous_days", "risk_label",
    ).orderBy("city", "year")


def _city_profile(profile: DataFrame, keys: list[str]) -> DataFrame:
    return (
        profile.where((F.col("parameter") == "pm25") & (F.col("is_outlier_station") == 0))
        .groupBy(*keys)
        .agg(F.round(F.avg("avg_value"), 1).alias("avg_pm25"))
    )


def analytics_seasonal_monthly(monthly: DataFrame) -> DataFrame:
    return _city_profile(monthly, ["city", "month_of_year"]).orderBy("city", "month_of_year")


def analytics_seasonal_diurnal(diurnal: DataFrame) -> DataFrame:
    keys = ["city", "day_type", "hour_of_day"]
    return _city_profile(diurnal, keys).orderBy(*keys)


def analytics_compliance(exceedance: DataFrame) -> DataFrame:
    return (
        exceedance.where(F.col("parameter") == "pm25")
        .select(
            "city", "year", "month_of_year", "who_exceedance_rate", "qcvn_exceedance_rate",
            "p95_pm25", "avg_pm25",
        )
        .orderBy("city", "year", "month_of_year")
    )


def analytics_forecast(forecasts: DataFrame, model: str) -> DataFrame:
    """Rows of the model's newest run."""
    of_model = forecasts.where(F.col("model") == model)
    newest = of_model.agg(F.max("generated_at").alias("generated_at"))
    return (
        of_model.join(newest, "generated_at")
        .select(
            "location_name", "city", F.col("forecast_date").cast("string").alias("forecast_date"),
            "forecast_pm25", "forecast_aqi", "forecast_aqi_category",
            "ci_lower_95", "ci_upper_95", "holdout_rmse",
        )
        .orderBy("location_name", "forecast_date")
    )


def latest_year(rows: DataFrame) -> DataFrame:
    """Rows of the newest year present."""
    return rows.join(rows.agg(F.max("year").alias("year")), "year")


def health_kpis(health: DataFrame) -> DataFrame:
    return latest_year(analytics_health(health)).select(
        "city", "year", "who_compliance_pct", "avg_pm25", "avg_cigarette_equivalent", "risk_label"
    )


def axis_values(rows: DataFrame, column: str) -> DataFrame:
    """Distinct, ordered values of a chart axis."""
    return rows.select(column).distinct().orderBy(column)


def pivot_series(
    rows: DataFrame, axis: str, series: str, values: list[str], measure: str
) -> DataFrame:
    """One column per series over an axis, NULL where a series has no value.

    The series names are given, so no extra job looks for them; of several rows for a cell the largest counts.
    """
    return rows.groupBy(axis).pivot(series, values).agg(F.max(measure)).orderBy(axis)


def forecast_kpis(latest_run: DataFrame) -> DataFrame:
    """Mean RMSE over stations, number of stations, station-days above the alert level."""
    per_station = latest_run.groupBy("location_name").agg(
        F.min_by("holdout_rmse", "forecast_date").alias("holdout_rmse"),
        F.count_if(F.col("forecast_aqi") > C.AQI_ALERT_ABOVE).alias("high"),
    )
    return per_station.agg(
        F.round(F.avg("holdout_rmse"), 1).alias("mean_rmse"),
        F.count(F.lit(1)).alias("stations"),
        F.coalesce(F.sum("high"), F.lit(0)).alias("high_aqi_days"),
    )
