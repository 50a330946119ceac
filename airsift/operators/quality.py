"""Data-quality checks. A check finds failing rows; a table passes when there are none."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsift.functions import aqi
from airsift.functions import constants as C
from airsift.operators.daily import trusted

Tables = dict[str, DataFrame]


def not_null(column: str) -> Column:
    return F.col(column).isNull()


def accepted_values(column: str, values: Sequence) -> Column:
    """A missing value passes."""
    return ~F.col(column).isin(list(values))


def accepted_range(column: str, low: float, high: float, when: Column | None = None) -> Column:
    outside = ~F.col(column).between(low, high)
    return outside if when is None else when & outside


def at_least(larger: str, smaller: str, when: Column | None = None) -> Column:
    below = F.col(larger) < F.col(smaller)
    return below if when is None else when & below


def category_mismatch() -> Column:
    """Health category that is not the band of the composite AQI."""
    return F.col("health_category") != aqi.category_from_aqi(F.col("composite_aqi"))


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once; counted before the shuffle."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def orphans(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Child rows whose key has no parent; a missing key passes."""
    keyed = child.where(F.col(column).isNotNull())
    return keyed.join(parent.select(column), column, "left_anti")


def too_few_rows(df: DataFrame, minimum: int = 1) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") < minimum)


def stale(df: DataFrame, as_of: dt.date, max_age_days: int, column: str = "measurement_date") -> DataFrame:
    """The newest date when it is older than allowed; an empty table is not judged here."""
    oldest = F.lit(as_of - dt.timedelta(days=max_age_days))
    return df.agg(F.max(column).alias("newest")).where(F.col("newest") < oldest)


def composite_is_not_maximum(daily_aqi: DataFrame, daily_aq: DataFrame) -> DataFrame:
    expected = (
        trusted(daily_aq)
        .where(F.col("aqi_value").isNotNull())
        .groupBy("measurement_date", "location_id")
        .agg(F.max("aqi_value").alias("expected_composite"))
    )
    return (
        daily_aqi.select("measurement_date", "location_id", "composite_aqi")
        .join(expected, ["measurement_date", "location_id"])
        .where(F.col("composite_aqi") != F.col("expected_composite"))
    )


@dataclass(frozen=True)
class RowCheck:
    """A condition that marks a failing row; all row checks of a table share one scan."""

    name: str
    table: str
    failing: Column


@dataclass(frozen=True)
class TableCheck:
    """A query over the tables that returns the failing rows.

    ``day`` names their day column if a month's failing rows depend on that month's rows only.
    """

    name: str
    tables: tuple[str, ...]
    failing: Callable[[Tables], DataFrame]
    day: str | None = None


def _not_null(table: str, *columns: str) -> list[RowCheck]:
    return [RowCheck(f"not_null_{table}_{column}", table, not_null(column)) for column in columns]


# Grain of each mart: its key columns.
GRAINS = {
    "mart_daily_air_quality": ("measurement_date", "location_id", "parameter"),
    "mart_daily_aqi": ("measurement_date", "location_id"),
    "mart_health_summary": ("city", "year"),
    "mart_diurnal_profile": ("location_id", "parameter", "hour_of_day", "day_type", "season"),
    "mart_monthly_profile": ("location_id", "parameter", "month_of_year"),
    "mart_exceedance_stats": ("city", "parameter", "year", "month_of_year"),
    "mart_pollutant_ratio": ("location_id", "measurement_date"),
    "mart_annual_monthly_trend": ("city", "year", "month_of_year"),
    "mart_daily_weather": ("location_id", "measurement_date"),
    "mart_aq_weather_daily": ("location_id", "measurement_date"),
    "mart_lagged_features": ("location_id", "measurement_date"),
    "mart_feature_stats": ("location_id",),
    "mart_forecast_accuracy": ("location_id", "model", "forecast_date"),
}

# Columns that may not be missing, beyond the grain.
REQUIRED = {
    "stg_measurements": ("location_id", "sensor_id", "measured_at", "parameter", "measurement_value"),
    "stg_weather": ("location_id", "measurement_date", "hour_utc", "temperature_2m"),
    "int_measurements_enriched": ("location_id", "city"),
    "int_weather_enriched": ("location_id", "measurement_date", "city"),
    "mart_daily_air_quality": ("city", "avg_value", "reading_count"),
    "mart_daily_aqi": ("city", "composite_aqi", "dominant_pollutant", "health_category"),
    "mart_health_summary": ("total_days", "who_compliance_pct", "risk_label"),
    "mart_diurnal_profile": ("city", "avg_value"),
    "mart_monthly_profile": ("city", "season", "avg_value"),
    "mart_exceedance_stats": ("total_days",),
    "mart_annual_monthly_trend": ("total_days",),
    "mart_daily_weather": ("city",),
    "mart_aq_weather_daily": ("city",),
    "mart_lagged_features": ("city",),
}

CHILDREN_OF_STATIONS = (
    "mart_daily_air_quality", "mart_daily_aqi", "mart_diurnal_profile", "mart_monthly_profile",
)


def row_checks(models: Sequence[str] = ()) -> list[RowCheck]:
    checks = []
    for table in sorted({*GRAINS, *REQUIRED}):
        checks += _not_null(table, *GRAINS.get(table, ()), *REQUIRED.get(table, ()))
    daily, composite = "mart_daily_air_quality", "mart_daily_aqi"
    measured = F.col("avg_value").isNotNull()
    checks += [
        RowCheck("accepted_parameters", "stg_measurements", accepted_values("parameter", C.KNOWN_STAGED_PARAMETERS)),
        RowCheck("max_at_least_avg", daily, at_least("max_value", "avg_value", measured)),
        RowCheck("avg_at_least_min", daily, at_least("avg_value", "min_value", measured)),
        RowCheck("accepted_composite_range", composite, accepted_range("composite_aqi", 0, 500)),
        RowCheck("accepted_dominant_pollutant", composite, accepted_values("dominant_pollutant", ["pm25", "pm10"])),
        RowCheck("accepted_health_category", composite, accepted_values("health_category", C.AQI_CATEGORIES)),
        RowCheck("pm25_between", composite, accepted_range("pm25_avg", 0, 500, F.col("pm25_avg").isNotNull())),
        RowCheck("category_matches_aqi", composite, category_mismatch()),
        RowCheck("accepted_risk_label", "mart_health_summary", accepted_values("risk_label", ["Low", "Moderate", "High", "Extreme"])),
        RowCheck("accepted_day_type", "mart_diurnal_profile", accepted_values("day_type", ["Weekday", "Weekend"])),
    ]
    if models:
        checks.append(RowCheck("accepted_model", "mart_forecast_accuracy", accepted_values("model", models)))
    return checks


def _day_in(keys: Sequence[str]) -> str | None:
    return "measurement_date" if "measurement_date" in keys else None


def table_checks(as_of: dt.date) -> list[TableCheck]:
    checks = [
        TableCheck(f"unique_{table}", (table,), lambda t, table=table, keys=keys: duplicates(t[table], keys), _day_in(keys))
        for table, keys in GRAINS.items()
    ]
    checks += [
        TableCheck(
            f"station_known_{table}",
            (table, "stations"),
            lambda t, table=table: orphans(t[table], t["stations"], "location_id"),
        )
        for table in CHILDREN_OF_STATIONS
    ]
    checks += [
        TableCheck(f"has_rows_{table}", (table,), lambda t, table=table: too_few_rows(t[table]))
        for table in ("mart_daily_air_quality", "mart_daily_aqi")
    ]
    checks += [
        TableCheck("fresh_measurements", ("mart_daily_aqi",), lambda t: stale(t["mart_daily_aqi"], as_of, 21)),
        TableCheck("fresh_weather", ("mart_daily_weather",), lambda t: stale(t["mart_daily_weather"], as_of, 7)),
        TableCheck(
            "composite_is_source_max",
            ("mart_daily_aqi", "mart_daily_air_quality"),
            lambda t: composite_is_not_maximum(t["mart_daily_aqi"], t["mart_daily_air_quality"]),
            "measurement_date",
        ),
    ]
    return checks


def row_check_counts(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """One row per check with its failing rows, all counted in a single scan."""
    counts = df.agg(*[F.count_if(check.failing).alias(check.name) for check in checks])
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.col(c.name).alias("failing_rows")) for c in checks])
    )
    return counts.select(pairs.alias("pair")).select("pair.*")


def check_counts(tables: Tables, rows: Sequence[RowCheck], queries: Sequence[TableCheck]) -> DataFrame:
    """Failing rows of every check whose tables are present."""
    parts = []
    for name in sorted({check.table for check in rows} & set(tables)):
        parts.append(row_check_counts(tables[name], [check for check in rows if check.table == name]))
    for check in queries:
        if set(check.tables) <= set(tables):
            counted = check.failing(tables).agg(F.count(F.lit(1)).alias("failing_rows"))
            parts.append(counted.select(F.lit(check.name).alias("check_name"), "failing_rows"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def run_checks(
    tables: Tables,
    as_of: dt.date,
    audit_path: str | None = None,
    models: Sequence[str] = (),
) -> DataFrame:
    """Summary of all checks; with ``audit_path`` failing rows are stored, one table per check that has some.

    The build is never stopped. Only the summary, one row per check, reaches the driver.
    """
    if audit_path is None:
        return check_counts(tables, row_checks(models), table_checks(as_of))
    from airsift.plans.audit import audited_checks  # the sinks are built on the operators

    spark = next(iter(tables.values())).sparkSession
    return audited_checks(spark, tables, as_of, audit_path, models)
