"""Flatten API answers (JSON text, one answer per row) into raw-zone rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsift import schemas

# Payload field -> column of the weather table.
HOURLY_FIELDS = {
    "temperature_2m": "temperature_2m",
    "relative_humidity_2m": "rh_2m",
    "wind_speed_10m": "wind_speed",
    "wind_direction_10m": "wind_dir",
    "precipitation": "precipitation_mm",
    "surface_pressure": "surface_pressure_hpa",
    "boundary_layer_height": "boundary_layer_height_m",
}


def explode_hourly(payloads: DataFrame, dates: DataFrame) -> DataFrame:
    """``(location_id, payload)`` to one row per station, day and hour of the wanted dates.

    ``dates`` has one DATE column ``date``. An answer holds at most one station's
    requested range, so exploding it stays inside the task that read it.
    """
    hourly = F.from_json("payload", schemas.HOURLY_PAYLOAD)["hourly"]
    series = ["time", *HOURLY_FIELDS]
    entry = F.explode(F.arrays_zip(*[hourly[name].alias(name) for name in series]))
    rows = payloads.select("location_id", entry.alias("entry")).select(
        "location_id",
        F.substring("entry.time", 1, 10).alias("date"),
        F.substring("entry.time", 12, 2).try_cast("int").alias("hour_utc"),
        *[F.col(f"entry.{name}").alias(column) for name, column in HOURLY_FIELDS.items()],
    )
    wanted = dates.select(F.date_format("date", "yyyy-MM-dd").alias("date")).distinct()
    return rows.join(wanted, "date", "left_semi")


def sensor_lookup(payloads: DataFrame) -> DataFrame:
    """``(location_id, payload)`` station answers to one row per sensor.

    Sensors without an id are dropped. When a sensor is listed more than once, the
    highest station id and then the last entry of its answer wins.
    """
    station = F.try_element_at(F.from_json("payload", schemas.STATION_PAYLOAD)["results"], F.lit(1))
    sensors = payloads.select("location_id", station.alias("station")).select(
        "location_id", "station", F.posexplode("station.sensors").alias("position", "sensor")
    )
    details = F.struct(
        F.coalesce("sensor.parameter.name", F.lit("")).alias("parameter"),
        F.coalesce("sensor.parameter.units", F.lit("")).alias("units"),
        F.coalesce("station.name", F.lit("")).alias("location_name"),
        F.col("station.coordinates.latitude").alias("lat"),
        F.col("station.coordinates.longitude").alias("lon"),
        F.col("location_id"),
    )
    return (
        sensors.where(F.coalesce(F.col("sensor.id"), F.lit(0)) != 0)
        .groupBy(F.col("sensor.id").alias("sensor_id"))
        .agg(F.max_by(details, F.struct("location_id", "position")).alias("details"))
        .select("sensor_id", "details.*")
    )


def _first_nonzero(reading: Column, lookup: Column) -> Column:
    return F.coalesce(F.nullif(reading, F.lit(0.0)), lookup)


def flatten_latest(payloads: DataFrame, sensors: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """``(location_id, payload)`` latest-readings answers to raw stream rows.

    Unknown sensors keep empty parameter and units. A missing value becomes the
    sentinel, which validation rejects later; text that is not a number stays NULL.
    """
    results = F.from_json("payload", schemas.LATEST_PAYLOAD)["results"]
    readings = payloads.select("location_id", F.explode(results).alias("reading"))
    lookup = sensors.select(
        F.col("sensor_id").alias("sensors_id"),
        "parameter",
        "units",
        F.col("location_name").alias("location"),
        F.col("lat").alias("sensor_lat"),
        F.col("lon").alias("sensor_lon"),
    )
    flat = readings.select(
        "location_id",
        F.col("reading.sensorsId").alias("sensors_id"),
        F.col("reading.datetime").alias("moment"),
        F.col("reading.coordinates.latitude").alias("reading_lat"),
        F.col("reading.coordinates.longitude").alias("reading_lon"),
        F.coalesce(F.col("reading.value"), F.lit("-999.0")).try_cast("double").alias("value"),
    )
    as_object = F.col("moment").startswith("{")
    moment = F.when(as_object, F.coalesce(F.get_json_object("moment", "$.utc"), F.lit(""))).otherwise(
        F.coalesce("moment", F.lit(""))
    )
    arrival = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return flat.join(lookup, "sensors_id", "left").select(
        F.col("location_id").cast("bigint").alias("location_id"),
        "sensors_id",
        F.coalesce("location", F.lit("")).alias("location"),
        moment.alias("datetime"),
        _first_nonzero(F.col("reading_lat"), F.col("sensor_lat")).alias("lat"),
        _first_nonzero(F.col("reading_lon"), F.col("sensor_lon")).alias("lon"),
        F.coalesce("parameter", F.lit("")).alias("parameter"),
        F.coalesce("units", F.lit("")).alias("units"),
        "value",
        (arrival if ingested_at is None else ingested_at).alias("ingested_at"),
    )
