"""Staging and enrichment of readings and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsift.functions import rules


def _parsed_measurements(raw: DataFrame) -> DataFrame:
    """Archive columns cast; a cell that cannot be read becomes NULL instead of failing the job."""
    instant = F.col("datetime").try_cast("timestamp")
    return raw.select(
        F.col("location_id").try_cast("int").alias("location_id"),
        F.col("sensors_id").try_cast("int").alias("sensor_id"),
        "location",
        instant.alias("measured_at"),
        instant.cast("date").alias("measurement_date"),
        F.round(F.col("lat").try_cast("double"), 6).alias("lat"),
        F.round(F.col("lon").try_cast("double"), 6).alias("lon"),
        F.lower("parameter").alias("parameter"),
        "units",
        F.col("value").try_cast("double").alias("measurement_value"),
    )


def stage_measurements(raw: DataFrame) -> DataFrame:
    """Typed archive readings without missing, sentinel, negative or implausible values.

    Dates and times are UTC: the session must run with time zone UTC.
    """
    accepted = rules.archive_row_accepted(
        F.col("location_id"), F.col("measured_at"), F.col("parameter"), F.col("measurement_value")
    )
    return _parsed_measurements(raw).where(accepted)


# Decimal places kept per weather column.
WEATHER_DIGITS = {
    "temperature_2m": 4,
    "rh_2m": 2,
    "wind_speed": 4,
    "wind_dir": 2,
    "precipitation_mm": 4,
    "surface_pressure_hpa": 2,
    "boundary_layer_height_m": 1,
}


def stage_weather(raw: DataFrame) -> DataFrame:
    """Typed hourly weather; hours without a readable date, hour or temperature are dropped."""
    typed = raw.select(
        F.col("location_id").try_cast("int").alias("location_id"),
        F.col("date").try_cast("date").alias("measurement_date"),
        F.col("hour_utc").try_cast("int").alias("hour_utc"),
        *[
            F.round(F.col(name).try_cast("double"), digits).alias(name)
            for name, digits in WEATHER_DIGITS.items()
        ],
    )
    return typed.dropna(subset=["measurement_date", "hour_utc", "temperature_2m"])


STATION_ATTRIBUTES = [
    "location_name", "city", "province", "station_lat", "station_lon", "sensor_type", "is_outlier_station",
]


def station_attributes(stations: DataFrame) -> DataFrame:
    return stations.withColumnsRenamed({"latitude": "station_lat", "longitude": "station_lon"}).select(
        "location_id", *STATION_ATTRIBUTES
    )


def restrict_to_stations(rows: DataFrame, stations: DataFrame) -> DataFrame:
    """Keep rows of allowlisted stations.

    Only the ids are joined. Spark broadcasts them when their measured size is below
    the broadcast threshold, otherwise it runs a shuffled join with skew splitting.
    """
    return rows.join(stations.select("location_id"), "location_id", "left_semi")


def attach_station(rows: DataFrame, stations: DataFrame, attributes: list[str] | None = None) -> DataFrame:
    chosen = STATION_ATTRIBUTES if attributes is None else attributes
    return rows.join(station_attributes(stations).select("location_id", *chosen), "location_id")


def enrich_measurements(measurements: DataFrame, stations: DataFrame) -> DataFrame:
    """Readings of allowlisted stations with the station's canonical attributes."""
    return attach_station(measurements, stations)


def enrich_weather(weather: DataFrame, stations: DataFrame) -> DataFrame:
    return attach_station(weather, stations, ["location_name", "city", "province", "sensor_type"])


def split_live_readings(readings: DataFrame) -> DataFrame:
    """Readings with ``is_valid`` and ``reason``; works on batch and streaming frames."""
    reason = rules.rejection_reason(F.col("value"), F.col("parameter"))
    return readings.withColumn("reason", reason).withColumn("is_valid", F.col("reason") == "")


def valid_readings(readings: DataFrame) -> DataFrame:
    return split_live_readings(readings).where("is_valid").drop("is_valid", "reason")


def rejected_readings(readings: DataFrame) -> DataFrame:
    return split_live_readings(readings).where(~F.col("is_valid")).drop("is_valid")


def counts_of_rejected(marked: DataFrame) -> DataFrame:
    """Rejected readings per parameter, from rows that ``split_live_readings`` has marked."""
    parameter = rules.parameter_or_unknown(F.col("parameter")).alias("parameter")
    return marked.where(~F.col("is_valid")).groupBy(parameter).agg(F.count(F.lit(1)).alias("rejected"))


def rejection_counts(readings: DataFrame) -> DataFrame:
    return counts_of_rejected(split_live_readings(readings))
