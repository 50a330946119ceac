"""City marts: station means become one city mean per day, days become months or years.

The first step keeps a city from counting once per station.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsift.functions import aqi, stats
from airsift.functions import constants as C
from airsift.operators.daily import trusted_pm25

def _mean() -> Column:
    return F.col("pm25_city_avg")


def city_daily(daily_aq: DataFrame, keys: list[str]) -> DataFrame:
    """Unrounded city mean of PM2.5 per day."""
    return (
        trusted_pm25(daily_aq)
        .groupBy(*keys, "measurement_date")
        .agg(F.avg("avg_value").alias("pm25_city_avg"))
        .withColumns({"year": F.year("measurement_date"), "month_of_year": F.month("measurement_date")})
    )


def mart_health_summary(daily_aq: DataFrame) -> DataFrame:
    """City x year day counts per category and WHO compliance.

    Categories and compliance are judged on the unrounded city mean; the averages use
    the mean rounded to four places.
    """
    days = city_daily(daily_aq, ["city", "province"]).select(
        "city",
        "province",
        "year",
        F.round(_mean(), 4).alias("mean_pm25"),
        aqi.cigarettes(_mean()).alias("cigarettes"),
        (_mean() <= F.lit(C.WHO_DAILY_LIMIT)).alias("compliant"),
        aqi.pm25_category(_mean()).alias("category"),
    )
    columns = ["good", "moderate", "usg", "unhealthy", "very_unhealthy", "hazardous"]
    counts = [
        F.count_if(F.col("category") == label).alias(f"{name}_days")
        for name, label in zip(columns, C.AQI_CATEGORIES)
    ]
    return (
        days.groupBy("city", "province", "year")
        .agg(
            F.count(F.lit(1)).alias("total_days"),
            *counts,
            F.count_if("compliant").alias("who_compliant_days"),
            stats.rate_percent(F.col("compliant")).alias("who_compliance_pct"),
            F.round(F.avg("mean_pm25"), 1).alias("avg_pm25"),
            F.round(F.avg("cigarettes"), 2).alias("avg_cigarette_equivalent"),
            F.round(F.max("mean_pm25"), 1).alias("max_pm25"),
        )
        .withColumn("risk_label", aqi.compliance_risk(F.col("who_compliance_pct")))
    )


def _over_who() -> Column:
    return _mean() > F.lit(C.WHO_DAILY_LIMIT)


def _over_national() -> Column:
    return _mean() > F.lit(C.NATIONAL_DAILY_LIMIT)


def mart_exceedance_stats(daily_aq: DataFrame) -> DataFrame:
    """City x parameter x year x month exceedance days and rates."""
    days = city_daily(daily_aq, ["city", "parameter"])
    return days.groupBy("city", "parameter", "year", "month_of_year").agg(
        F.count(F.lit(1)).alias("total_days"),
        F.count_if(_over_who()).alias("who_exceedance_days"),
        F.count_if(_over_national()).alias("qcvn_exceedance_days"),
        stats.rate_percent(_over_who()).alias("who_exceedance_rate"),
        stats.rate_percent(_over_national()).alias("qcvn_exceedance_rate"),
        F.round(F.avg(_mean()), 2).alias("avg_pm25"),
        F.round(stats.percentile(_mean(), 0.95, exact=True), 2).alias("p95_pm25"),
    )


def mart_annual_monthly_trend(daily_aq: DataFrame) -> DataFrame:
    """City x province x year x month means, peaks and exceedance rates."""
    days = city_daily(daily_aq, ["city", "province"])
    return days.groupBy("city", "province", "year", "month_of_year").agg(
        F.count(F.lit(1)).alias("total_days"),
        F.round(F.avg(_mean()), 2).alias("avg_pm25"),
        F.round(F.max(_mean()), 2).alias("max_pm25"),
        F.round(stats.percentile(_mean(), 0.95, exact=True), 2).alias("p95_pm25"),
        stats.rate_percent(_over_who()).alias("who_exceedance_rate"),
        stats.rate_percent(_over_national()).alias("qcvn_exceedance_rate"),
    )
