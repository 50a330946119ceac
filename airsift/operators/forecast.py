"""Per-station forecasts: window baselines, a grouped-map job for fitted models, accuracy.

A series holds one row per station-day, so both a window partition and a grouped-map
group are bounded by the number of days of history, whatever the raw volume.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from airsift.functions import aqi, stats
from airsift.functions import constants as C
from airsift.operators.daily import trusted_pm25

NORMAL_95 = 1.96
STATION = ["location_id", "location_name", "city"]


def _by_date() -> WindowSpec:
    return Window.partitionBy("location_id").orderBy("measurement_date")


def station_series(features: DataFrame) -> DataFrame:
    """Non-null daily PM2.5 per station; text that is not a number counts as 0."""
    value = F.coalesce(F.col("avg_pm25").try_cast("double"), F.lit(0.0))
    return features.where(F.col("avg_pm25").isNotNull()).select(
        *STATION, "measurement_date", value.alias("avg_pm25")
    )


def eligible_stations(
    series: DataFrame,
    as_of: dt.date,
    min_rows: int = C.MIN_TRAIN_ROWS,
    max_age_days: int = C.MAX_STALENESS_DAYS,
) -> DataFrame:
    """Stations with enough history and recent data."""
    return (
        series.groupBy("location_id")
        .agg(F.count(F.lit(1)).alias("series_rows"), F.max("measurement_date").alias("last_date"))
        .where(
            (F.col("series_rows") >= min_rows)
            & (F.date_diff(F.lit(as_of), "last_date") <= max_age_days)
        )
    )


def eligible_series(series: DataFrame, as_of: dt.date, **limits: int) -> DataFrame:
    return series.join(eligible_stations(series, as_of, **limits), "location_id", "left_semi")


def horizon_dates(last_dates: DataFrame, horizon: int = C.FORECAST_HORIZON) -> DataFrame:
    """``(…, last_date)`` to one row per forecast day."""
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    return last_dates.select("*", step.alias("step")).withColumn(
        "forecast_date", F.expr("date_add(last_date, step)")
    )


BASELINES = ("snaive7", "mean7")


def baseline_predictions() -> dict[str, Column]:
    """One-step predictions that use only earlier rows of the same station."""
    return {
        "snaive7": F.lag("avg_pm25", 7).over(_by_date()),
        "mean7": F.avg("avg_pm25").over(_by_date().rowsBetween(-7, -1)),
    }


def baseline_one_step(series: DataFrame, models: dict[str, Column] | None = None) -> DataFrame:
    """Long form: the one-step prediction of each baseline for every observed day."""
    models = models or baseline_predictions()
    count = F.count(F.lit(1)).over(Window.partitionBy("location_id"))
    predicted = series.withColumns(
        {
            **models,
            "series_rows": count,
            "position": F.row_number().over(_by_date()),
            "previous_date": F.lag("measurement_date", 1).over(_by_date()),
        }
    )
    pairs = F.explode(
        F.array(*[F.struct(F.lit(name).alias("model"), F.col(name).alias("predicted")) for name in models])
    )
    kept = [*STATION, "measurement_date", "avg_pm25", "series_rows", "position", "previous_date"]
    return predicted.select(*kept, pairs.alias("pair")).select(*kept, "pair.*")


def backtest_steps(rows: Column, holdout: int, min_rows: int) -> Column:
    """Held-out rows at the end of a series of ``rows`` rows."""
    return F.least(F.lit(holdout), F.greatest(rows - min_rows, F.lit(0)))


def baseline_backtest(
    series: DataFrame,
    holdout: int = C.HOLDOUT_DAYS,
    min_rows: int = C.MIN_TRAIN_ROWS,
) -> DataFrame:
    """Walk-forward RMSE per station and baseline; 0.0 where nothing can be held out."""
    error = F.when(
        F.col("position") > F.col("series_rows") - F.col("steps"), F.col("predicted") - F.col("avg_pm25")
    )
    return (
        baseline_one_step(series)
        .withColumn("steps", backtest_steps(F.col("series_rows"), holdout, min_rows).cast("int"))
        .groupBy(*STATION, "model", "series_rows", "steps")
        .agg(F.round(F.coalesce(F.sqrt(F.avg(error * error)), F.lit(0.0)), 4).alias("holdout_rmse"))
    )


def baseline_forecasts(
    series: DataFrame, generated_at: str, horizon: int = C.FORECAST_HORIZON
) -> DataFrame:
    """Seasonal-naive and trailing-mean forecasts of the next days with AQI columns.

    Only the last seven rows of a station are gathered.
    """
    newest_first = Window.partitionBy("location_id").orderBy(F.desc("measurement_date"))
    recent = (
        series.withColumn("age", F.row_number().over(newest_first))
        .where(F.col("age") <= 7)
        .groupBy("location_id")
        .agg(
            F.max("measurement_date").alias("last_date"),
            F.avg("avg_pm25").alias("mean7"),
            F.array_sort(F.collect_list(F.struct("measurement_date", "avg_pm25"))).alias("week"),
        )
    )
    same_weekday = F.try_element_at("week", (F.col("step") - 1) % F.size("week") + 1)["avg_pm25"]
    future = horizon_dates(recent, horizon).withColumn("snaive7", same_weekday)
    pairs = F.explode(
        F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("mean")) for m in BASELINES])
    )
    forecasts = future.select("location_id", "forecast_date", pairs.alias("pair")).select(
        "location_id", "forecast_date", "pair.*"
    )
    margin = F.lit(NORMAL_95) * F.col("holdout_rmse")
    scored = forecasts.join(
        baseline_backtest(series).select(*STATION, "model", "holdout_rmse"), ["location_id", "model"]
    ).withColumns({"lower": F.col("mean") - margin, "upper": F.col("mean") + margin})
    return as_forecast_rows(scored, F.lit(generated_at))


def as_forecast_rows(scored: DataFrame, generated_at: Column) -> DataFrame:
    """Forecast-table rows from mean and bounds: clipped at 0, rounded, with AQI and category."""

    def clipped(name: str) -> Column:
        return F.greatest(F.col(name), F.lit(0.0))

    index = aqi.forecast_aqi(clipped("mean"))
    return scored.select(
        *STATION,
        "forecast_date",
        F.round(clipped("mean"), 4).alias("forecast_pm25"),
        index.alias("forecast_aqi"),
        aqi.category_from_aqi(index).alias("forecast_aqi_category"),
        F.round(clipped("lower"), 4).alias("ci_lower_95"),
        F.round(clipped("upper"), 4).alias("ci_upper_95"),
        F.round("holdout_rmse", 4).alias("holdout_rmse"),
        generated_at.alias("generated_at"),
        "model",
    )


class FittedModel(Protocol):
    def forecast(self, history: np.ndarray, horizon: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mean, lower and upper bound of the steps that follow ``history``."""


@dataclass(frozen=True)
class LagDifference:
    """Day-to-day changes regressed on the previous change and the change a week before."""

    daily: float
    weekly: float
    sigma: float

    @classmethod
    def fit(cls, train: np.ndarray) -> LagDifference:
        change = np.diff(train)
        if len(train) < C.WEEKLY_TERM_FROM_ROWS:
            target, lags = change[1:], change[:-1, None]
        else:
            target, lags = change[7:], np.column_stack([change[6:-1], change[:-7]])
        weights, *_ = np.linalg.lstsq(lags, target, rcond=None)
        residual = target - lags @ weights
        sigma = float(np.sqrt(np.sum(residual**2) / max(len(target) - lags.shape[1], 1)))
        return cls(float(weights[0]), float(weights[1]) if len(weights) > 1 else 0.0, sigma)

    def forecast(self, history: np.ndarray, horizon: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        changes = list(np.diff(history[-9:]))
        for _ in range(horizon):
            week_ago = changes[-7] if len(changes) >= 7 else 0.0
            changes.append(self.daily * changes[-1] + self.weekly * week_ago)
        mean = history[-1] + np.cumsum(changes[-horizon:])
        margin = NORMAL_95 * self.sigma * np.sqrt(np.arange(1, horizon + 1))
        return mean, mean - margin, mean + margin


Fitter = Callable[[np.ndarray], FittedModel]


def walk_forward_rmse(values: np.ndarray, fit: Fitter, holdout: int, min_rows: int) -> float:
    """Fit once before the holdout, then predict one step at a time on observed history.

    A failing walk gives the error of one forecast over the whole holdout, and 0.0 if that
    fails too: a backtest never costs the forecast itself.
    """
    steps = min(holdout, max(len(values) - min_rows, 0))
    if steps < 1:
        return 0.0
    split = len(values) - steps

    def error(predicted: Sequence[float]) -> float:
        return float(np.sqrt(np.mean((np.maximum(predicted, 0.0) - values[split:]) ** 2)))

    try:
        model = fit(values[:split])
        try:
            return error([model.forecast(values[:end], 1)[0][0] for end in range(split, len(values))])
        except Exception:  # any fitter may be plugged in
            return error(model.forecast(values[:split], steps)[0])
    except Exception:
        return 0.0


GROUPED_SCHEMA = (
    "location_id int, location_name string, city string, forecast_date date, "
    "mean double, lower double, upper double, holdout_rmse double, status string"
)


def fit_series(
    series: DataFrame,
    fit: Fitter = LagDifference.fit,
    horizon: int = C.FORECAST_HORIZON,
    holdout: int = C.HOLDOUT_DAYS,
    min_rows: int = C.MIN_TRAIN_ROWS,
) -> DataFrame:
    """Fit one model per station on the executors; a failing station yields one error row.

    Rows are taken in date order as an evenly spaced sequence; gaps are ignored.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        head = frame.iloc[0][STATION].to_dict()
        try:
            ordered = frame.sort_values("measurement_date")
            values = ordered["avg_pm25"].to_numpy(dtype=float)
            rmse = walk_forward_rmse(values, fit, holdout, min_rows)
            mean, lower, upper = fit(values).forecast(values, horizon)
            last = ordered["measurement_date"].iloc[-1]
            days = [last + dt.timedelta(days=step) for step in range(1, horizon + 1)]
            result = {"forecast_date": days, "mean": mean, "lower": lower, "upper": upper}
            return pd.DataFrame({**head, **result, "holdout_rmse": rmse, "status": "ok"})
        except Exception as failure:  # one bad series must not fail the job
            empty = dict.fromkeys(["forecast_date", "mean", "lower", "upper", "holdout_rmse"])
            return pd.DataFrame([{**head, **empty, "status": f"{type(failure).__name__}: {failure}"}])

    return series.groupBy("location_id").applyInPandas(run, GROUPED_SCHEMA)


def model_forecasts(fitted: DataFrame, generated_at: str, model: str) -> DataFrame:
    """Forecast-table rows of the stations that were fitted."""
    good = fitted.where(F.col("status") == "ok").withColumn("model", F.lit(model))
    return as_forecast_rows(good, F.lit(generated_at))


def alert_rows(forecasts: DataFrame, above: int = C.AQI_ALERT_ABOVE) -> DataFrame:
    return forecasts.where(F.col("forecast_aqi") > above).select(
        *STATION, "model", "forecast_date", "forecast_pm25", "forecast_aqi"
    )


def city_rmse(forecasts: DataFrame) -> DataFrame:
    """Mean over stations of each station's RMSE, per city and model."""
    per_station = forecasts.groupBy("location_id", "city", "model").agg(
        F.max("holdout_rmse").alias("holdout_rmse")
    )
    return per_station.groupBy("city", "model").agg(F.avg("holdout_rmse").alias("mean_rmse"))


def run_summary(series: DataFrame, fitted: DataFrame, forecasts: DataFrame) -> DataFrame:
    """One row: stations not failed, errors, forecast rows and alert rows."""
    marks = [
        series.select("location_id").distinct().select(F.lit("station").alias("kind")),
        fitted.where(F.col("status") != "ok").select(F.lit("error").alias("kind")),
        forecasts.select(
            F.when(F.col("forecast_aqi") > C.AQI_ALERT_ABOVE, "alert").otherwise("record").alias("kind")
        ),
    ]
    kind = F.col("kind")
    return (
        marks[0]
        .unionAll(marks[1])
        .unionAll(marks[2])
        .agg(
            (F.count_if(kind == "station") - F.count_if(kind == "error")).alias("stations_ok"),
            F.count_if(kind == "error").alias("errors"),
            F.count_if(kind.isin("record", "alert")).alias("records"),
            F.count_if(kind == "alert").alias("alert_count"),
        )
    )


def latest_runs(forecasts: DataFrame) -> DataFrame:
    """The newest run's row for each station, model and forecast date."""
    newest_first = Window.partitionBy("location_id", "model", "forecast_date").orderBy(
        F.desc("generated_at")
    )
    return (
        forecasts.withColumn("_run", F.row_number().over(newest_first)).where("_run = 1").drop("_run")
    )


# Rolling metric: output name, error column averaged, rows in the frame, take the root.
ROLLING: Sequence[tuple[str, str, int, bool]] = (
    ("rolling_rmse_7d", "squared_error", 7, True),
    ("rolling_rmse_30d", "squared_error", 30, True),
    ("rolling_mae_30d", "abs_error", 30, False),
    ("rolling_bias_30d", "error", 30, False),
)


def mart_forecast_accuracy(forecasts: DataFrame, daily_aq: DataFrame) -> DataFrame:
    """Station x model x forecast date with errors and rolling error metrics.

    Days without an actual value keep NULL errors and metrics. They form their own
    window partitions, so the rolling frames count observed days only and the rows
    need no second pass. Placing the forecasts by station and date serves both the
    choice of the newest run and the join.
    """
    actual = trusted_pm25(daily_aq).select(
        "location_id",
        F.col("measurement_date").alias("forecast_date"),
        F.col("avg_value").alias("actual_pm25"),
    )
    gap = F.col("forecast_pm25") - F.col("actual_pm25")
    matched = (
        latest_runs(forecasts.repartition("location_id", "forecast_date"))
        .join(actual, ["location_id", "forecast_date"], "left")
        .withColumns(
            {
                "error": F.round(gap, 4),
                "abs_error": F.round(F.abs(gap), 4),
                "squared_error": F.round(F.pow(gap, F.lit(2.0)), 4),
            }
        )
    )
    observed = F.col("actual_pm25").isNotNull()
    series = Window.partitionBy("location_id", "model", observed).orderBy("forecast_date")

    def rolling(column: str, rows: int, root: bool) -> Column:
        mean = F.avg(column).over(series.rowsBetween(-(rows - 1), 0))
        return stats.settled_round(F.sqrt(mean) if root else mean, 2)

    return matched.withColumns(
        {name: rolling(column, rows, root) for name, column, rows, root in ROLLING}
    )
