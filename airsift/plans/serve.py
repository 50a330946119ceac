"""Read queries over the stored tables: the days asked for decide which month folders are opened at all."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from airsift.operators import monitoring, serving
from airsift.plans.versions import Snapshot, committed

DAY = "measurement_date"
COMPOSITE = "mart_daily_aqi"


def days_of(spark: SparkSession, target: str, table: str, first: dt.date | None = None, last: dt.date | None = None, day: str = DAY) -> DataFrame:
    """Rows of a stored table from ``first`` to ``last``, in the newest snapshot; other months are neither listed nor opened."""
    return committed(spark, target).open(spark, table, day=day, first=first, last=last)


def latest_station_aqi(spark: SparkSession, target: str, as_of: dt.date, days: int = 7) -> DataFrame:
    """``serving.latest_station_aqi`` of the stored table: opens the month of the first day looked at and later ones."""
    return serving.latest_station_aqi(days_of(spark, target, COMPOSITE, as_of - dt.timedelta(days=days)), as_of, days)


def _newest_rows(spark: SparkSession, snapshot: Snapshot, table: str) -> DataFrame:
    """The rows of the newest stored month, the newest day among them; all rows (none with a day) if there is no month."""
    newest = snapshot.newest_month(table)
    return snapshot.open(spark, table, day=DAY if newest else None, first=newest)


def completeness(spark: SparkSession, target: str, as_of: dt.date, expected: int, alert_below: int, stale_after_days: int = 7) -> DataFrame:
    """``monitoring.completeness`` of the stored table: only its newest month is opened."""
    rows = _newest_rows(spark, committed(spark, target), COMPOSITE)
    return monitoring.completeness(rows, as_of, expected, alert_below, stale_after_days)
