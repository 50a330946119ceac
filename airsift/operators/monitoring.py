"""Operational metrics in long form, station completeness and alarm rules."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def completeness(
    daily_aqi: DataFrame,
    as_of: dt.date,
    expected: int,
    alert_below: int,
    stale_after_days: int = 7,
) -> DataFrame:
    """One row about the newest date in the mart.

    An empty mart counts as no active station today. Old data raises no alert, since
    a late archive is not a failure of the job.
    """
    # Over a stored table ``plans.serve.completeness`` hands over the newest month only.
    newest_date = daily_aqi.agg(F.max("measurement_date").alias("measurement_date"))
    newest = (
        daily_aqi.select("measurement_date", "location_id")
        .join(newest_date, "measurement_date")
        .agg(
            F.coalesce(F.max("measurement_date"), F.lit(as_of)).alias("check_date"),
            F.count_distinct("location_id").cast("int").alias("active"),
        )
    )
    age = F.date_diff(F.lit(as_of), "check_date")
    return newest.select(
        "check_date",
        age.alias("data_age_days"),
        (age > stale_after_days).alias("is_archive_stale"),
        "active",
        F.greatest(F.lit(expected) - F.col("active"), F.lit(0)).alias("missing"),
        F.lit(expected).alias("expected"),
        F.lit(alert_below).alias("alert_threshold"),
        ((F.col("active") < alert_below) & (age <= stale_after_days)).alias("alert"),
    )


def metric_rows(df: DataFrame, metric: str, value: Column, at: Column, dimension: Column | None = None) -> DataFrame:
    """One metric value per input row."""
    return df.select(
        F.lit(metric).alias("metric"),
        (F.lit("") if dimension is None else dimension).cast("string").alias("dimension"),
        at.cast("timestamp").alias("ts"),
        value.cast("double").alias("value"),
    )


def completeness_metrics(report: DataFrame, at: Column) -> DataFrame:
    """Missing stations and age of the mart."""
    pairs = [("MissingStations", "missing"), ("DaysSinceLastNewMart", "data_age_days")]
    both = F.array(*[F.struct(F.lit(metric).alias("metric"), F.col(name).cast("double").alias("value")) for metric, name in pairs])
    return report.select(F.explode(both).alias("one"), at.cast("timestamp").alias("ts")).select(
        "one.metric", F.lit("").alias("dimension"), "ts", "one.value"
    )


def rejection_metrics(counts: DataFrame, at: Column) -> DataFrame:
    return metric_rows(counts, "ValidationRejections", F.col("rejected"), at, F.col("parameter"))


def failure_metrics(outcomes: DataFrame, metric: str, at: Column) -> DataFrame:
    """Number of failed units of a run (0 too) from rows with an ``error`` column."""
    failed = outcomes.agg(F.count("error").alias("failed"))
    return metric_rows(failed, metric, F.col("failed"), at)


def rmse_metrics(rmse: DataFrame, at: Column) -> DataFrame:
    name = F.concat_ws("/", "model", "city")
    return metric_rows(rmse, "ForecastRMSE", F.col("mean_rmse"), at, name)


@dataclass(frozen=True)
class AlarmRule:
    """Fires when the metric is above ``threshold`` in ``periods`` consecutive periods."""

    metric: str
    threshold: float
    periods: int = 1
    period_seconds: int = 86_400
    average: bool = False


def default_rules(expected: int, alert_below: int) -> list[AlarmRule]:
    # Thresholds and periods of the documented alarms.
    return [
        AlarmRule("MissingStations", expected - alert_below, periods=2, period_seconds=3600),
        AlarmRule("DaysSinceLastNewMart", 21, periods=2, period_seconds=3600),
        AlarmRule("BatchStationFailures", 0),
        AlarmRule("WeatherIngestErrors", 5),
        AlarmRule("ForecastRMSE", 25, periods=3, average=True),
    ]


def evaluate_alarms(metrics: DataFrame, rules: Iterable[AlarmRule]) -> DataFrame:
    """Each breaching period with its streak length and whether the alarm fires; metrics are read once.

    A period without data does not breach, so it ends a streak: within a streak the
    period number and the row number grow together and their difference stays fixed.
    """
    listed = F.array(
        *[
            F.struct(
                F.lit(place).alias("rule"), F.lit(rule.metric).alias("of"), F.lit(float(rule.threshold)).alias("threshold"),
                F.lit(rule.periods).alias("periods"), F.lit(rule.period_seconds).alias("seconds"), F.lit(rule.average).alias("average"),
            )
            for place, rule in enumerate(rules)
        ]
    )
    own = F.filter(listed, lambda rule: rule["of"] == F.col("metric"))
    ruled = metrics.select("metric", "dimension", "ts", "value", F.explode(own).alias("rule"))
    period = F.floor(F.unix_timestamp("ts") / F.col("rule.seconds")).alias("period")
    breaches = (
        ruled.groupBy("metric", "dimension", "rule", period)
        .agg(F.avg("value").alias("mean"), F.max("value").alias("highest"))
        .withColumn("value", F.when(F.col("rule.average"), F.col("mean")).otherwise(F.col("highest")))
        .where(F.col("value") > F.col("rule.threshold"))
        .select(
            "metric", "dimension", "period", "value", F.col("rule.rule").alias("rule"), F.col("rule.periods").alias("periods_needed"),
            F.timestamp_seconds(F.col("period") * F.col("rule.seconds")).alias("period_start"),
        )
    )
    by_period = Window.partitionBy("metric", "dimension", "rule").orderBy("period")
    streak = Window.partitionBy("metric", "dimension", "rule", "streak_id").orderBy("period")
    return (
        breaches.withColumn("streak_id", F.col("period") - F.row_number().over(by_period))
        .withColumn("streak", F.row_number().over(streak))
        .select(
            "metric", "dimension", "period_start", "value", "streak",
            (F.col("streak") >= F.col("periods_needed")).alias("alarm"),
        )
    )
