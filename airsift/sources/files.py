"""Readers of the raw zone, the seeds and the forecast table. Schemas are always declared."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airsift import schemas


def read_measurements(spark: SparkSession, path: str) -> DataFrame:
    """Archive of delimited gzip files under ``locationid=/year=/month=`` folders.

    Filters on the folder columns prune whole folders. A gzip file cannot be split,
    so one task reads at least one file; the many small files of this archive are
    packed into tasks by ``spark.sql.files.maxPartitionBytes``.
    """
    schema = f"{schemas.MEASUREMENTS_RAW}, {schemas.MEASUREMENTS_PARTITIONS}"
    return spark.read.schema(schema).option("header", True).option("quote", '"').csv(path)


# Stations a reader names to the scan one by one; a longer list is joined.
LISTED_STATIONS = 10_000


def of_stations(rows: DataFrame, stations: DataFrame) -> DataFrame:
    """Archive rows in the folders of the listed stations; other folders are not opened.

    The ids are read on the driver, up to ``LISTED_STATIONS`` of them, and filter the folder column, so they prune at
    planning. More stations than that are joined on the folder column instead.
    """
    ids = stations.select(F.col("location_id").cast("string").alias("locationid")).where("locationid is not null").distinct()
    listed = ids.limit(LISTED_STATIONS + 1).collect()
    if len(listed) > LISTED_STATIONS:
        return rows.join(ids, "locationid", "left_semi")
    return rows.where(F.col("locationid").isin([row[0] for row in listed]))


def backfill(
    spark: SparkSession, path: str, years: Iterable[int] = (), stations: Iterable[int] = ()
) -> DataFrame:
    """Archive rows of the chosen years and stations; no choice means all of them."""
    rows = read_measurements(spark, path)
    chosen_years = [str(year) for year in years]
    chosen_stations = [str(station) for station in stations]
    if chosen_years:
        rows = rows.where(F.col("year").isin(chosen_years))
    if chosen_stations:
        rows = rows.where(F.col("locationid").isin(chosen_stations))
    return rows


LANDING_HOURS = "y string, m string, d string, h string, batch string"


def read_stream_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landed live readings: gzip JSON lines in ``y=/m=/d=/h=/batch=`` folders.

    Filters on ``y``, ``m``, ``d`` and ``h`` (text, zero-padded) prune folders. For folders
    named ``2024/01/31/07`` pass a pattern that reaches the hours, for instance
    ``.../2024/01/*/*``; the arrival time then comes from the path and those columns are NULL.
    """
    rows = spark.read.schema(f"{schemas.STREAM_RAW}, {LANDING_HOURS}").json(path).withColumn("_file", F.col("_metadata.file_path"))
    named = {"arrival_year": "y", "arrival_month": "m", "arrival_day": "d", "arrival_hour": "h"}
    pattern = r"/(\d{4})/(\d{2})/(\d{2})/(\d{2})/[^/]*$"
    parts = [
        F.coalesce(folder, F.regexp_extract("_file", pattern, position)).try_cast("int").alias(name)
        for position, (name, folder) in enumerate(named.items(), start=1)
    ]
    return rows.select(*schemas.STREAM_COLUMNS, *parts, "y", "m", "d", "h")


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Hourly weather as JSON lines in ``day=`` folders; filters on ``day`` prune folders.

    For files in foreign folders, name them by a pattern, for instance ``.../*/2024/01/*``;
    ``day`` is then NULL.
    """
    return spark.read.schema(f"{schemas.WEATHER_RAW}, day string").json(path)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Station seed; it is also the allowlist of stations."""
    return spark.read.schema(schemas.STATIONS).option("header", True).csv(path)


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.HOLIDAYS).option("header", True).csv(path)


def typed_holidays(holidays: DataFrame) -> DataFrame:
    """Holidays with a readable date; a flag that is not a number becomes NULL."""
    typed = holidays.select(
        F.col("date").try_cast("date").alias("holiday_date"),
        "holiday_name",
        F.col("is_tet_period").try_cast("int").alias("is_tet_period"),
    )
    return typed.dropna(subset=["holiday_date"])


def read_forecasts(spark: SparkSession, path: str) -> DataFrame:
    """Forecast table under ``generated_at=/model=`` folders; both stay text."""
    schema = f"{schemas.FORECAST}, {schemas.FORECAST_PARTITIONS}"
    return spark.read.schema(schema).parquet(path)
