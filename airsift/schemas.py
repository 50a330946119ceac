"""Declared schemas of the raw zone, the seeds and the forecast table, as DDL text."""

from __future__ import annotations

# The archive is delimited text: every cell is text until staging casts it.
MEASUREMENTS_RAW = (
    "location_id string, sensors_id string, location string, datetime string, "
    "lat string, lon string, parameter string, units string, value string"
)
# Folder levels of the archive, kept as text so `month=01` survives.
MEASUREMENTS_PARTITIONS = "locationid string, year string, month string"

STREAM_RAW = (
    "location_id bigint, sensors_id bigint, location string, datetime string, "
    "lat double, lon double, parameter string, units string, value double, ingested_at string"
)

STREAM_COLUMNS = [
    "location_id", "sensors_id", "location", "datetime", "lat", "lon", "parameter", "units", "value",
    "ingested_at",
]

WEATHER_RAW = (
    "location_id int, date string, hour_utc int, temperature_2m double, rh_2m double, "
    "wind_speed double, wind_dir double, precipitation_mm double, "
    "surface_pressure_hpa double, boundary_layer_height_m double"
)

STATIONS = (
    "location_id int, location_name string, city string, province string, "
    "latitude double, longitude double, sensor_type string, is_outlier_station int"
)

HOLIDAYS = "date string, holiday_name string, is_tet_period string"

FORECAST = (
    "location_id int, location_name string, city string, forecast_date date, "
    "forecast_pm25 double, forecast_aqi int, forecast_aqi_category string, "
    "ci_lower_95 double, ci_upper_95 double, holdout_rmse double"
)
FORECAST_PARTITIONS = "generated_at string, model string"

# One weather API answer per station: parallel arrays, one entry per hour.
HOURLY_PAYLOAD = (
    "hourly struct<time: array<string>, temperature_2m: array<double>, "
    "relative_humidity_2m: array<double>, wind_speed_10m: array<double>, "
    "wind_direction_10m: array<double>, precipitation: array<double>, "
    "surface_pressure: array<double>, boundary_layer_height: array<double>>"
)

# Station metadata answer: the sensors a station carries.
STATION_PAYLOAD = (
    "results array<struct<name: string, "
    "coordinates: struct<latitude: double, longitude: double>, "
    "sensors: array<struct<id: bigint, parameter: struct<name: string, units: string>>>>>"
)

# Latest-readings answer. `datetime` arrives either as an object or as plain text,
# so it is read as text and taken apart afterwards.
LATEST_PAYLOAD = (
    "results array<struct<datetime: string, value: string, sensorsId: bigint, "
    "coordinates: struct<latitude: double, longitude: double>>>"
)
