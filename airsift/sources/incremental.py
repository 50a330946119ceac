"""What to ingest next: listed files, new or changed ones, month windows, day ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airsift.sources.listing import list_files


def archive_listing(spark: SparkSession, archive: str, name_pattern: str = "*.csv.gz") -> DataFrame:
    """The archive's files with ``etag`` (length and time of change), ``station_id`` and ``month_start`` of their folders.

    Read from file metadata; no content is opened.
    """
    part = {name: F.regexp_extract("path", rf"/{name}=([^/]*)/", 1) for name in ("locationid", "year", "month")}
    month = F.concat_ws("-", part["year"], F.lpad(part["month"], 2, "0"), F.lit("01")).try_cast("date")
    return list_files(spark, archive, name_pattern).select(
        "path",
        F.concat_ws("-", "length", F.unix_millis("modified")).alias("etag"),
        part["locationid"].try_cast("int").alias("station_id"),
        month.alias("month_start"),
    )


def new_or_changed(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files ``(path, etag)`` whose path and etag are not yet in the ledger."""
    return listing.join(ledger.select("path", "etag"), ["path", "etag"], "left_anti")


def ingest_summary(
    listing: DataFrame,
    ledger: DataFrame,
    unit: str = "station_id",
    outcomes: DataFrame | None = None,
    window: tuple[dt.date, int] | None = None,
) -> DataFrame:
    """Copied, skipped and failed files per unit, and an error of a failed one.

    ``window`` (a day, n) looks only at files whose ``month_start`` is among the n months up to that day. ``outcomes``
    has ``path`` and ``error`` of files that could not be copied. A unit whose files all failed still has its row.
    """
    if window is not None:
        listing = in_month_window(listing, *window)
    seen = ledger.select("path", "etag", F.lit(True).alias("seen")).distinct()
    marked = listing.join(seen, ["path", "etag"], "left")
    if outcomes is None:
        marked = marked.withColumn("error", F.lit(None).cast("string"))
    else:
        failed = outcomes.where("error is not null").groupBy("path").agg(F.min("error").alias("error"))
        marked = marked.join(failed, "path", "left")
    new = F.col("seen").isNull()
    return marked.groupBy(unit).agg(
        F.count_if(new & F.col("error").isNull()).alias("copied"),
        F.count_if(~new).alias("skipped"),
        F.count_if(new & F.col("error").isNotNull()).alias("failed"),
        F.min(F.when(new, F.col("error"))).alias("error"),
    )


def in_month_window(listing: DataFrame, as_of: dt.date, months: int) -> DataFrame:
    """Files of the last ``months`` months, the month of ``as_of`` included; a filter on the folders' month."""
    first = F.add_months(F.trunc(F.lit(as_of), "MM"), -(months - 1))
    return listing.where((F.col("month_start") >= first) & (F.col("month_start") <= F.lit(as_of)))


def updated_ledger(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger after the ingest: the listed etag replaces an older one of the same path."""
    kept = ledger.select("path", "etag").join(listing.select("path"), "path", "left_anti")
    return kept.unionByName(listing.select("path", "etag"))


def month_window(as_of: DataFrame, months: int) -> DataFrame:
    """First day of the month of each ``as_of`` date and of the months before it."""
    first = F.trunc("as_of", "MM")
    every_month = F.sequence(
        F.add_months(first, -(months - 1)), first, F.make_interval(months=F.lit(1))
    )
    return as_of.select(F.explode(every_month).alias("month_start")).select(
        "month_start",
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month"),
    )


def trailing_days(as_of: Column, days: int) -> Column:
    """Array of the consecutive dates ending the day before ``as_of``."""
    return F.sequence(F.date_sub(as_of, days), F.date_sub(as_of, 1))


def backfill_days(as_of: DataFrame, days: int) -> DataFrame:
    return as_of.select(F.explode(trailing_days(F.col("as_of"), days)).alias("date"))


def weather_backfill(weather: DataFrame, as_of: DataFrame, days: int) -> DataFrame:
    """Weather rows of the last ``days`` days; days without data simply have no rows."""
    wanted = backfill_days(as_of, days).withColumnRenamed("date", "measurement_date")
    return weather.join(wanted, "measurement_date", "left_semi")


def missing_weather_days(weather: DataFrame, stations: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Station-days of the backfill range for which no hourly row exists."""
    expected = stations.select(
        "location_id", F.explode(trailing_days(as_of, days)).alias("measurement_date")
    )
    return expected.join(weather, ["location_id", "measurement_date"], "left_anti")
