"""The forecast run: features in, one forecast partition and its metrics out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airsift.operators import forecast
from airsift.plans.writers import write_forecasts, write_table
from airsift.sources.files import read_forecasts


def run_forecasts(
    spark: SparkSession,
    features: DataFrame,
    target: str,
    as_of: dt.date,
    fit: forecast.Fitter = forecast.LagDifference.fit,
    model: str = "lagdiff",
) -> tuple[DataFrame, DataFrame]:
    """Fit, store the run under ``generated_at=/model=`` and return the forecasts and a summary.

    The fitted rows are written before they are used twice, so no model is fitted again.
    """
    generated_at = as_of.isoformat()
    series = forecast.station_series(features)
    fitted = forecast.fit_series(forecast.eligible_series(series, as_of), fit)
    fitted_path = f"{target.rstrip('/')}/fitted/{generated_at}-{model}"
    write_table(fitted, fitted_path)
    stored = spark.read.schema(forecast.GROUPED_SCHEMA).parquet(fitted_path)
    table = f"{target.rstrip('/')}/mart_daily_forecast"
    write_forecasts(forecast.model_forecasts(stored, generated_at, model), table)
    run = read_forecasts(spark, table).where(
        (F.col("generated_at") == generated_at) & (F.col("model") == model)
    )
    return run, forecast.run_summary(series, stored, run)
