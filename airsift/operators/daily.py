"""Daily marts per station: pollutants, composite AQI, weather, and their join.

Raw rows are aggregated on narrow id keys before anything is joined or shuffled, so
a station holding a large share of the readings still sends at most one row per map
task, sensor, parameter and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airsift.functions import aqi
from airsift.functions import constants as C
from airsift.functions import weather as wx
from airsift.operators.staging import STATION_ATTRIBUTES, attach_station, restrict_to_stations

STATION_DAY = ["location_id", "measurement_date"]


def sensor_day_totals(measurements: DataFrame) -> DataFrame:
    """Mergeable totals per station, day, parameter and sensor."""
    value = F.col("measurement_value")
    return measurements.groupBy(*STATION_DAY, "parameter", "sensor_id").agg(
        F.sum(value).alias("value_sum"),
        F.max(value).alias("highest"),
        F.min(value).alias("lowest"),
        F.count(F.lit(1)).alias("readings"),
    )


def _parameter_days(measurements: DataFrame) -> DataFrame:
    """Station-day-parameter totals, placed so that one station-day lies in one partition."""
    placed = sensor_day_totals(measurements).repartition(*STATION_DAY)
    return placed.groupBy(*STATION_DAY, "parameter").agg(
        (F.sum("value_sum") / F.sum("readings")).alias("mean_value"),
        F.round(F.max("highest"), 4).alias("max_value"),
        F.round(F.min("lowest"), 4).alias("min_value"),
        F.sum("readings").alias("reading_count"),
        F.count("sensor_id").alias("sensor_count"),
    )


def mart_daily_air_quality(measurements: DataFrame, stations: DataFrame) -> DataFrame:
    """Date x station x parameter, with AQI, limits and the humidity-corrected value.

    The day's mean humidity comes from the same aggregate through a window over the
    station-day instead of a second scan; such a window holds one row per parameter.
    """
    humidity = F.when(F.col("parameter") == "relativehumidity", F.round("mean_value", 2))
    per_parameter = (
        _parameter_days(restrict_to_stations(measurements, stations))
        .withColumn("avg_rh", F.max(humidity).over(Window.partitionBy(*STATION_DAY)))
        .withColumn("avg_value", F.round("mean_value", 4))
    )
    rows = attach_station(per_parameter, stations)
    parameter, value = F.col("parameter"), F.col("avg_value")
    return rows.select(
        "measurement_date",
        "location_id",
        "parameter",
        *STATION_ATTRIBUTES,
        "avg_value",
        "max_value",
        "min_value",
        "reading_count",
        "sensor_count",
        aqi.aqi(parameter, value).alias("aqi_value"),
        aqi.aqi_category(parameter, value).alias("aqi_category"),
        aqi.above_limit(parameter, value, C.WHO_DAILY_LIMIT).alias("exceeds_who_24h"),
        aqi.above_limit(parameter, value, C.NATIONAL_DAILY_LIMIT).alias("exceeds_qcvn"),
        aqi.who_compliant(parameter, value).alias("who_compliant_day"),
        F.when(parameter == "pm25", aqi.cigarettes(value)).alias("cigarette_equivalent"),
        aqi.humidity_corrected(parameter, F.col("sensor_type"), value, F.col("avg_rh")).alias(
            "corrected_pm25"
        ),
    )


def trusted(daily_aq: DataFrame) -> DataFrame:
    """Rows of stations not flagged as outliers."""
    return daily_aq.where(F.col("is_outlier_station") == 0)


def trusted_pm25(daily_aq: DataFrame) -> DataFrame:
    return trusted(daily_aq).where(F.col("parameter") == "pm25")


def mart_daily_aqi(daily_aq: DataFrame) -> DataFrame:
    """Date x station: the worst pollutant's AQI and category, PM2.5 winning ties.

    One aggregation: the winning row is picked by its AQI plus half a point for PM2.5,
    which cannot change the order because AQI is an integer.
    """
    is_pm25 = F.col("parameter") == "pm25"
    rank = F.col("aqi_value") + F.when(is_pm25, 0.5).otherwise(0.0)
    carried = [name for name in STATION_ATTRIBUTES if name != "is_outlier_station"]
    winner = F.struct(
        F.col("aqi_value").alias("composite_aqi"),
        F.col("parameter").alias("dominant_pollutant"),
        F.col("aqi_category").alias("health_category"),
        *carried,
    )
    return (
        trusted(daily_aq)
        .where(F.col("aqi_value").isNotNull())
        .groupBy(*STATION_DAY)
        .agg(
            F.max_by(winner, rank).alias("winner"),
            F.max(F.when(is_pm25, F.col("avg_value"))).alias("pm25_avg"),
            F.max(F.when(is_pm25, F.col("cigarette_equivalent"))).alias("cigarette_equivalent"),
        )
        .select(*STATION_DAY, "winner.*", "pm25_avg", "cigarette_equivalent")
    )


def mart_daily_weather(weather: DataFrame, stations: DataFrame) -> DataFrame:
    """Station x date weather aggregates with the two dispersion flags."""
    daily = (
        restrict_to_stations(weather, stations)
        .groupBy(*STATION_DAY)
        .agg(
            F.round(F.avg("temperature_2m"), 4).alias("avg_temperature_2m"),
            F.round(F.max("temperature_2m"), 4).alias("max_temperature_2m"),
            F.round(F.min("temperature_2m"), 4).alias("min_temperature_2m"),
            F.round(F.avg("rh_2m"), 2).alias("avg_rh_2m"),
            F.round(F.max("rh_2m"), 2).alias("max_rh_2m"),
            F.round(F.min("rh_2m"), 2).alias("min_rh_2m"),
            F.round(F.avg("wind_speed"), 4).alias("avg_wind_speed"),
            F.round(wx.circular_mean(F.col("wind_dir")), 2).alias("avg_wind_dir"),
            wx.calm_hours(F.col("wind_speed")).alias("calm_wind_hours"),
            F.round(F.sum("precipitation_mm"), 4).alias("total_precipitation_mm"),
            F.round(F.avg("surface_pressure_hpa"), 2).alias("avg_surface_pressure_hpa"),
            F.round(F.avg("boundary_layer_height_m"), 1).alias("avg_boundary_layer_height_m"),
            F.round(F.min("boundary_layer_height_m"), 1).alias("min_boundary_layer_height_m"),
            F.count(F.lit(1)).alias("reading_count_hours"),
        )
        .withColumns(
            {
                "inversion_risk": wx.inversion_risk(
                    F.col("min_boundary_layer_height_m"), F.col("avg_wind_speed")
                ),
                "wet_scavenging": wx.wet_scavenging(F.col("total_precipitation_mm")),
            }
        )
    )
    return attach_station(daily, stations, ["location_name", "city", "province", "sensor_type"])


WEATHER_COVARIATES = [
    "avg_temperature_2m", "max_temperature_2m", "min_temperature_2m",
    "avg_rh_2m", "max_rh_2m", "min_rh_2m",
    "avg_wind_speed", "avg_wind_dir", "calm_wind_hours", "total_precipitation_mm",
    "avg_surface_pressure_hpa", "avg_boundary_layer_height_m", "min_boundary_layer_height_m",
    "inversion_risk", "wet_scavenging",
]


def mart_aq_weather_daily(daily_aq: DataFrame, daily_weather: DataFrame) -> DataFrame:
    """Trusted PM2.5 station-days with weather covariates, NULL where weather is missing."""
    air = trusted_pm25(daily_aq).select(
        *STATION_DAY,
        "location_name", "city", "province", "sensor_type",
        F.col("avg_value").alias("avg_pm25"),
        F.col("max_value").alias("max_pm25"),
        "corrected_pm25", "aqi_value", "aqi_category",
        "exceeds_who_24h", "exceeds_qcvn", "cigarette_equivalent",
    )
    covariates = daily_weather.select(*STATION_DAY, *WEATHER_COVARIATES)
    return air.join(covariates, STATION_DAY, "left")


def mart_pollutant_ratio(daily_aq: DataFrame) -> DataFrame:
    """Station x date PM2.5/PM10 ratio; rows stay when the ratio cannot be formed."""
    keys = ["location_id", "location_name", "city", "province", "measurement_date"]
    parameters = ["pm25", "pm10", "pm1"]

    def mean_of(name: str):
        return F.round(F.max(F.when(F.col("parameter") == name, F.col("avg_value"))), 4).alias(f"{name}_avg")

    ratio = aqi.pm_ratio(F.col("pm25_avg"), F.col("pm10_avg"))
    return (
        trusted(daily_aq)
        .where(F.col("parameter").isin(parameters))
        .groupBy(*keys)
        .agg(*[mean_of(name) for name in parameters])
        .withColumn("pm25_pm10_ratio", F.round(ratio, 4))
        .withColumn("source_indicator", aqi.particle_source(ratio))
    )
