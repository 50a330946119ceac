"""Report datasets over the marts: scorecard, weather drivers, compliance, forecast monitor."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsift.functions import weather as wx


def choose(rows: DataFrame, **choices: Collection | None) -> DataFrame:
    """Multi-select filters by column; an empty or missing choice keeps every row."""
    for column, values in choices.items():
        if values:
            rows = rows.where(F.col(column).isin(list(values)))
    return rows


def mean_by(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.avg(name).alias(name) for name in measures])


DAY_COUNTS = [
    "good_days", "moderate_days", "usg_days", "unhealthy_days", "very_unhealthy_days", "hazardous_days",
]


def scorecard(health: DataFrame) -> DataFrame:
    """Overall averages and unhealthy-day totals."""
    return health.agg(
        F.avg("avg_cigarette_equivalent").alias("avg_cigarette_equivalent"),
        F.avg("who_compliance_pct").alias("who_compliance_pct"),
        F.avg("avg_pm25").alias("avg_pm25"),
        F.sum("unhealthy_days").alias("unhealthy_days"),
        F.sum("hazardous_days").alias("hazardous_days"),
    )


def health_days_by_city(health: DataFrame) -> DataFrame:
    return health.groupBy("city").agg(*[F.sum(name).alias(name) for name in DAY_COUNTS])


def annual_trend(trend: DataFrame) -> DataFrame:
    return mean_by(trend, ["year", "city"], ["avg_pm25", "who_exceedance_rate"])


def pm25_by_inversion(aq_weather: DataFrame) -> DataFrame:
    return mean_by(aq_weather, ["inversion_risk", "city"], ["avg_pm25"])


def pm25_by_washout(aq_weather: DataFrame) -> DataFrame:
    return mean_by(aq_weather, ["wet_scavenging", "city"], ["avg_pm25"])


def wind_and_pm25(aq_weather: DataFrame) -> DataFrame:
    return mean_by(aq_weather, ["city"], ["avg_wind_speed", "avg_pm25"])


def pm25_by_wind_sector(aq_weather: DataFrame) -> DataFrame:
    sectors = aq_weather.withColumn("wind_sector", wx.wind_sector(F.col("avg_wind_dir")))
    return mean_by(sectors, ["wind_sector", "city"], ["avg_pm25"])


def ratio_by_source(ratios: DataFrame) -> DataFrame:
    return mean_by(ratios, ["city", "source_indicator"], ["pm25_pm10_ratio"])


def monthly_means(aq_weather: DataFrame, measures: list[str], by: list[str] | None = None) -> DataFrame:
    month = F.trunc("measurement_date", "MM").alias("month")
    rows = aq_weather.select(month, *(by or []), *measures)
    return mean_by(rows, ["month", *(by or [])], measures)


def raw_and_corrected(aq_weather: DataFrame) -> DataFrame:
    return monthly_means(aq_weather, ["avg_pm25", "corrected_pm25"])


def humidity_and_pm25(aq_weather: DataFrame) -> DataFrame:
    return monthly_means(aq_weather, ["avg_rh_2m", "avg_pm25"])


def pressure_and_pm25(aq_weather: DataFrame) -> DataFrame:
    return monthly_means(aq_weather, ["avg_surface_pressure_hpa", "avg_pm25"])


def calm_hours(aq_weather: DataFrame) -> DataFrame:
    return monthly_means(aq_weather, ["calm_wind_hours"], ["city"])


def diurnal_by_city(diurnal: DataFrame) -> DataFrame:
    return mean_by(diurnal, ["hour_of_day", "city"], ["avg_value"])


def exceedance_trend(exceedance: DataFrame) -> DataFrame:
    return mean_by(exceedance, ["year", "city"], ["who_exceedance_rate", "qcvn_exceedance_rate"])


def p95_by_month(exceedance: DataFrame) -> DataFrame:
    return mean_by(exceedance, ["month_of_year", "city"], ["p95_pm25"])


def compliance_split(exceedance: DataFrame) -> DataFrame:
    """Days per year: within the WHO limit, above it only, above the national limit too."""
    who, national = F.col("who_exceedance_days"), F.col("qcvn_exceedance_days")
    return exceedance.groupBy("year").agg(
        F.sum(F.col("total_days") - who).alias("compliant_days"),
        F.sum(who - national).alias("who_only_days"),
        F.sum(national).alias("qcvn_exceedance_days"),
    )


def year_month_heatmap(trend: DataFrame) -> DataFrame:
    """Mean PM2.5 with one row per year and one column per month."""
    names = [f"m{month:02d}" for month in range(1, 13)]
    months = F.format_string("m%02d", "month_of_year")
    return trend.withColumn("m", months).groupBy("year").pivot("m", names).agg(F.avg("avg_pm25"))


def forecast_by_date(accuracy: DataFrame) -> DataFrame:
    measures = ["forecast_pm25", "ci_lower_95", "ci_upper_95", "rolling_rmse_30d"]
    return mean_by(accuracy, ["forecast_date", "model"], measures)


def actual_against_forecast(accuracy: DataFrame) -> DataFrame:
    measures = ["actual_pm25", "forecast_pm25", "holdout_rmse", "rolling_rmse_30d", "rolling_bias_30d"]
    return mean_by(accuracy, ["model"], measures)


def rmse_by_station(accuracy: DataFrame) -> DataFrame:
    return mean_by(accuracy, ["location_name", "model"], ["holdout_rmse"])
