"""Registered checks, monitoring, forecasts, sources, sinks and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsift import schemas
from airsift.functions import constants as C
from airsift.operators import forecast, monitoring, quality, staging
from airsift.plans import build, forecast_job, writers
from airsift.session import shared_folder
from airsift.sources import files, incremental, payloads
from airsift.streaming import live
from catalog.inputs import AS_OF, LIVE_AS_OF, WEATHER_RAW, Inputs
from catalog.oracle_ctes import aqi_category_sql, index_sql
from catalog.registry import register

DAYS = ["location_id", "measurement_date"]

# Checks ------------------------------------------------------------------------------


def _parsed(i: Inputs) -> DataFrame:
    return staging._parsed_measurements(i.measurements_raw)


register(
    "not_null_dq01",
    lambda i: quality.row_check_counts(
        _parsed(i),
        [
            quality.RowCheck(name, "raw", quality.not_null(name))
            for name in ("location_id", "sensor_id", "measured_at", "parameter", "measurement_value")
        ],
    ),
    """select 'location_id' as check_name, count(*) filter (location_id is null) as failing_rows from raw
       union all select 'sensor_id', count(*) filter (sensor_id is null) from raw
       union all select 'measured_at', count(*) filter (measured_at is null) from raw
       union all select 'parameter', count(*) filter (parameter is null) from raw
       union all select 'measurement_value', count(*) filter (unreadable) from raw""",
)
register(
    "unique_dq02",
    lambda i: quality.duplicates(i.stg, ["sensor_id"]),
    "select sensor_id, count(*) as n_rows from stg group by 1 having count(*) > 1",
)
register(
    "unique_combination_dq03",
    lambda i: quality.duplicates(i.stg_weather, [*DAYS, "hour_utc"]),
    "select location_id, measurement_date, hour_utc, count(*) as n_rows from stg_weather group by 1, 2, 3 having count(*) > 1",
)
register(
    "accepted_values_dq04",
    lambda i: i.live.where(quality.accepted_values("parameter", C.KNOWN_STAGED_PARAMETERS)).select("sensors_id", "parameter"),
    "select sensors_id, parameter from live where parameter not in ('pm25', 'pm10', 'o3')",
)
register(
    "accepted_range_dq06",
    lambda i: i.daily_aqi.where(quality.accepted_range("composite_aqi", 0, 300)).select(*DAYS, "composite_aqi"),
    "select location_id, measurement_date, composite_aqi from daily_aqi where composite_aqi < 0 or composite_aqi > 300",
)
register(
    "row_count_dq07",
    lambda i: quality.too_few_rows(i.stg, 10**12),
    "select count(*) as n_rows from stg having count(*) < 1000000000000",
)
register(
    "pair_order_dq08",
    lambda i: i.daily_aq.where(quality.at_least("avg_value", "max_value", F.col("reading_count") > 1)).select(*DAYS, "parameter"),
    "select location_id, measurement_date, parameter from daily_base where reading_count > 1 and avg_value < max_value",
)
register(
    "values_between_dq09",
    lambda i: i.daily_aqi.where(quality.accepted_range("pm25_avg", 0, 200, F.col("pm25_avg").isNotNull())).select(*DAYS, "pm25_avg"),
    "select location_id, measurement_date, pm25_avg from daily_aqi where pm25_avg > 200 or pm25_avg < 0",
)
register(
    "freshness_dq10_agg14",
    lambda i: quality.stale(i.daily_aqi, LIVE_AS_OF, 21),
    f"select max(measurement_date) as newest from daily_aqi having max(measurement_date) < date '{LIVE_AS_OF}' - 21",
)
register(
    "category_matches_dq12",
    lambda i: i.daily_aqi.where(quality.category_mismatch()).select(*DAYS, "composite_aqi", "health_category"),
    f"""select location_id, measurement_date, composite_aqi, health_category from daily_aqi
        where health_category <> {aqi_category_sql('composite_aqi')}""",
)
register(
    "completeness_dq13",
    lambda i: monitoring.completeness(i.daily_aqi, AS_OF, expected=21, alert_below=18),
    f"""select max(measurement_date) as check_date, cast(date '{AS_OF}' - max(measurement_date) as int) as data_age_days,
               date '{AS_OF}' - max(measurement_date) > 7 as is_archive_stale, active, 21 - active as missing, 21 as expected,
               18 as alert_threshold, active < 18 and date '{AS_OF}' - max(measurement_date) <= 7 as alert
        from daily_aqi, (select cast(count(distinct location_id) as int) as active from daily_aqi
                         where measurement_date = (select max(measurement_date) from daily_aqi))
        group by active""",
)
register(
    "run_metrics_dq14",
    lambda i: monitoring.rejection_metrics(staging.rejection_counts(i.live), F.lit(LIVE_AS_OF))
    .unionByName(
        monitoring.completeness_metrics(monitoring.completeness(i.daily_aqi, AS_OF, 21, 18), F.lit(AS_OF))
    )
    .unionByName(
        monitoring.rmse_metrics(forecast.city_rmse(i.next_week).withColumn("mean_rmse", F.round("mean_rmse", 6)), F.lit(AS_OF))
    )
    .unionByName(
        monitoring.failure_metrics(
            _ingested(i), "BatchStationFailures", F.lit(LIVE_AS_OF)
        )
    ),
    f"""select 'ValidationRejections' as metric, case parameter when '' then 'unknown' else parameter end as dimension,
               timestamp '{LIVE_AS_OF}' as ts, cast(count(*) as double) as value from judged where reason <> '' group by 2
        union all
        select 'MissingStations', '', timestamp '{AS_OF}', 21e0 - count(distinct location_id) from daily_aqi
        where measurement_date = (select max(measurement_date) from daily_aqi)
        union all
        select 'DaysSinceLastNewMart', '', timestamp '{AS_OF}', cast(date '{AS_OF}' - max(measurement_date) as double) from daily_aqi
        union all
        select 'ForecastRMSE', model || '/' || city, timestamp '{AS_OF}', round(avg(rmse), 6)
        from (select location_id, city, model, min(holdout_rmse) as rmse from next_week group by 1, 2, 3) group by 2
        union all
        select 'BatchStationFailures', '', timestamp '{LIVE_AS_OF}', count(distinct doc_id % 21)::double
        from documents where doc_id % 12 < 6 and (doc_id % 2 = 1 or doc_id % 10 = 0) and doc_id % 97 = 0""",
)
ALARMS = [
    monitoring.AlarmRule("MissingStations", 9, periods=3),
    monitoring.AlarmRule("MeanComposite", 180, periods=2, average=True),
]


def _daily_metrics(i: Inputs) -> DataFrame:
    per_day = i.daily_aqi.groupBy("measurement_date").agg(F.count(F.lit(1)).alias("active"))
    missing = monitoring.metric_rows(per_day, "MissingStations", F.lit(21) - F.col("active"), F.col("measurement_date"))
    index = monitoring.metric_rows(
        i.daily_aqi, "MeanComposite", F.col("composite_aqi"), F.col("measurement_date"), F.col("city")
    )
    return missing.unionByName(index)


register(
    "alarms_dq15_win07",
    lambda i: monitoring.evaluate_alarms(_daily_metrics(i), ALARMS).withColumn("value", F.round("value", 6)),
    """with recursive metric_days as (
           select 'MissingStations' as metric, '' as dimension, measurement_date as day, 21e0 - count(*) as value, 9 as limit_value, 3 as needed
           from daily_aqi group by 3
           union all
           select 'MeanComposite', city, measurement_date, avg(composite_aqi), 180, 2 from daily_aqi group by 2, 3),
       span as (select metric, dimension, min(day) - 1 as first_day, max(day) as last_day from metric_days group by 1, 2),
       every_day as (select metric, dimension, cast(unnest(generate_series(first_day, last_day, interval 1 day)) as date) as day from span),
       flagged as (select e.metric, e.dimension, e.day, m.value, m.needed, coalesce(m.value > m.limit_value, false) as breach
                   from every_day e left join metric_days m using (metric, dimension, day)),
       runs as (select *, day - max(day) filter (not breach) over (partition by metric, dimension order by day) as streak from flagged)
       select metric, dimension, cast(day as timestamp) as period_start, round(value, 6) as value, cast(streak as int) as streak,
              streak >= needed as alarm from runs where breach""",
)

MART_SQL_NAMES = {
    "stg_measurements": "stg", "stg_weather": "stg_weather", "int_measurements_enriched": "enriched",
    "int_weather_enriched": "weather_enriched", "mart_daily_air_quality": "daily_aq", "mart_daily_aqi": "daily_aqi",
    "mart_health_summary": "health", "mart_diurnal_profile": "diurnal", "mart_monthly_profile": "monthly",
    "mart_exceedance_stats": "exceedance", "mart_pollutant_ratio": "ratio", "mart_annual_monthly_trend": "trend",
    "mart_daily_weather": "daily_weather", "mart_aq_weather_daily": "aq_weather", "mart_lagged_features": "features",
}


def _checks_sql() -> str:
    parts = []

    def counted(name: str, source: str) -> None:
        parts.append(f"select '{name}' as check_name, count(*) as failing_rows from {source}")

    for table, source in MART_SQL_NAMES.items():
        columns = dict.fromkeys([*quality.GRAINS.get(table, ()), *quality.REQUIRED.get(table, ())])
        for column in columns:
            counted(f"not_null_{table}_{column}", f"{source} where {column} is null")
        if table in quality.GRAINS:
            keys = ", ".join(quality.GRAINS[table])
            counted(f"unique_{table}", f"(select 1 from {source} group by {keys} having count(*) > 1)")
        if table in quality.CHILDREN_OF_STATIONS:
            counted(f"station_known_{table}", f"{source} where location_id not in (select location_id from stations)")
    for table in ("mart_daily_air_quality", "mart_daily_aqi"):
        counted(f"has_rows_{table}", f"(select 1 from {MART_SQL_NAMES[table]} having count(*) < 1)")
    counted("accepted_parameters", "stg where parameter not in ('pm25', 'pm10', 'relativehumidity')")
    counted("max_at_least_avg", "daily_aq where max_value < avg_value")
    counted("avg_at_least_min", "daily_aq where avg_value < min_value")
    counted("accepted_composite_range", "daily_aqi where composite_aqi not between 0 and 500")
    counted("accepted_dominant_pollutant", "daily_aqi where dominant_pollutant not in ('pm25', 'pm10')")
    counted("accepted_health_category", "daily_aqi where health_category not in ('Good', 'Moderate', 'Unhealthy for Sensitive Groups', 'Unhealthy', 'Very Unhealthy', 'Hazardous')")
    counted("pm25_between", "daily_aqi where pm25_avg not between 0 and 500")
    counted("category_matches_aqi", f"daily_aqi where health_category <> {aqi_category_sql('composite_aqi')}")
    counted("accepted_risk_label", "health where risk_label not in ('Low', 'Moderate', 'High', 'Extreme')")
    counted("accepted_day_type", "diurnal where day_type not in ('Weekday', 'Weekend')")
    counted("fresh_measurements", f"(select 1 from daily_aqi having max(measurement_date) < date '{AS_OF}' - 21)")
    counted("fresh_weather", f"(select 1 from daily_weather having max(measurement_date) < date '{AS_OF}' - 7)")
    counted("composite_is_source_max", "(select 1 from indexed join daily_aqi using (measurement_date, location_id) group by measurement_date, location_id having max(aqi_value) <> max(composite_aqi))")
    return "\nunion all ".join(parts)


def _daily_run(i: Inputs) -> DataFrame:
    """The whole day's work, from text cells: all 17 tables, the forecasts among them, and every check."""
    sources = {
        "measurements_raw": i.measurements_raw, "weather_raw": i.weather_raw, "stations": i.stations, "holidays": i.holidays,
    }
    return build.daily_run(i.spark, sources, shared_folder(i.spark, "build"), AS_OF)[1]


REMOVED_DAY, REMOVED_MONTH, SINCE = dt.date(2001, 9, 3), dt.date(2001, 10, 1), dt.date(2001, 9, 1)


def _corrected_build(i: Inputs) -> DataFrame:
    """A full build, then an increment from an archive that lost one day and one whole month."""
    target = shared_folder(i.spark, "build")
    sources = {"measurements_raw": i.readings, "weather_raw": i.weather_raw, "stations": i.stations, "holidays": i.holidays}
    build.build_all(i.spark, sources, target)
    day, month = F.to_date("datetime"), F.trunc(F.to_date("datetime"), "MM")
    lost = (day == F.lit(REMOVED_DAY)) | (month == F.lit(REMOVED_MONTH))
    fewer = {**sources, "measurements_raw": i.readings.where(~F.coalesce(lost, F.lit(False)))}
    tables = build.build_all(i.spark, fewer, target, since=SINCE)
    kept = tables["mart_daily_aqi"].select(F.lit("aqi").alias("source"), "measurement_date", "location_id", "composite_aqi")
    staged = tables["stg_measurements"].groupBy("measurement_date", "location_id").agg(F.count("*").cast("int").alias("composite_aqi"))
    lagged = tables["mart_lagged_features"].groupBy("location_id").agg(F.max("measurement_date").alias("measurement_date"), F.count("*").cast("int").alias("composite_aqi"))
    parts = [("staged", staged), ("lagged", lagged)]
    for name, rows in parts:
        kept = kept.unionByName(rows.select(F.lit(name).alias("source"), "measurement_date", "location_id", "composite_aqi"))
    return kept


LEFT = f"measurement_date <> date '{REMOVED_DAY}' and date_trunc('month', measurement_date) <> date '{REMOVED_MONTH}'"
register(
    "corrected_months_snk06",
    _corrected_build,
    f"""select 'aqi' as source, measurement_date, location_id, composite_aqi from daily_aqi where {LEFT}
        union all
        select 'staged', measurement_date, location_id, cast(count(*) as int) from stg where {LEFT} group by 2, 3
        union all
        select 'lagged', max(measurement_date), location_id, cast(count(*) as int) from aq_weather
        where avg_pm25 is not null and {LEFT} group by 3""",
)

# Forecasts ---------------------------------------------------------------------------

register(
    "station_series_fc01",
    lambda i: i.series,
    "select location_id, location_name, city, measurement_date, avg_pm25 from series",
)
ELIGIBLE_SQL = f"""select location_id, count(*) as series_rows, max(measurement_date) as last_date from pm25_days group by 1
                   having count(*) >= 60 and date '{AS_OF}' - max(measurement_date) <= 90"""
register("eligible_stations_fc02", lambda i: forecast.eligible_stations(i.series, AS_OF), ELIGIBLE_SQL)
register("baseline_backtest_fc04", lambda i: forecast.baseline_backtest(i.series), "select * from backtest")
register("baseline_forecast_fc05", lambda i: i.next_week, "select * from next_week")
register(
    "forecast_alerts_fc06",
    lambda i: forecast.alert_rows(i.next_week),
    "select location_id, location_name, city, model, forecast_date, forecast_pm25, forecast_aqi from next_week where forecast_aqi > 150",
)
register(
    "city_rmse_fc07_agg17",
    lambda i: forecast.city_rmse(i.next_week).withColumn("mean_rmse", F.round("mean_rmse", 6)),
    """select city, model, round(avg(rmse), 6) as mean_rmse
       from (select location_id, city, model, min(holdout_rmse) as rmse from next_week group by 1, 2, 3) group by 1, 2""",
)
register(
    "horizon_dates_fc09",
    lambda i: forecast.horizon_dates(forecast.eligible_stations(i.series, AS_OF)),
    f"""select location_id, series_rows, last_date, step, last_date + step as forecast_date
        from ({ELIGIBLE_SQL}) e, (select unnest(range(1, 8))::int as step)""",
)


def _fitted(i: Inputs) -> DataFrame:
    return forecast.fit_series(forecast.eligible_series(i.series, AS_OF))


CHANGES = """
    kept as (select * from series where location_id in (select location_id from eligible)),
    changes as (select *, avg_pm25 - lag(avg_pm25) over w as d, lag(avg_pm25) over w as before from kept
                window w as (partition by location_id order by position)),
    lagged as (select *, lag(d, 1) over w as d1, lag(d, 7) over w as d7,
                      series_rows - least(30, greatest(series_rows - 60, 0)) as split
               from changes window w as (partition by location_id order by position)),
    fit_rows as (select 'all' as part, * from lagged where d7 is not null
                 union all select 'train', * from lagged where d7 is not null and position <= split),
    sums as (select part, location_id, sum(d1 * d1) as s11, sum(d7 * d7) as s77, sum(d1 * d7) as s17,
                    sum(d * d1) as s1, sum(d * d7) as s7, count(*) as m from fit_rows group by 1, 2),
    weights as (select part, location_id, m, (s1 * s77 - s7 * s17) / (s11 * s77 - s17 * s17) as a,
                       (s7 * s11 - s1 * s17) / (s11 * s77 - s17 * s17) as b from sums),
    spread as (select r.location_id, sqrt(sum(power(d - a * d1 - b * d7, 2)) / (max(m) - 2)) as sigma
               from fit_rows r join weights w on w.part = r.part and w.location_id = r.location_id where r.part = 'all' group by 1),
    errors as (select l.location_id, case when max(series_rows - split) < 1 then 0 else
                      sqrt(avg(power(greatest(before + a * d1 + b * d7, 0) - avg_pm25, 2)) filter (position > split)) end as rmse
               from lagged l join weights w on w.location_id = l.location_id and w.part = 'train' group by 1),
    tail as (select location_id, location_name, city, max(series_rows) as n, max_by(avg_pm25, position) as y,
                    max(measurement_date) as last_date,
                    max(d) filter (position = series_rows) as c0, max(d) filter (position = series_rows - 6) as w1,
                    max(d) filter (position = series_rows - 5) as w2, max(d) filter (position = series_rows - 4) as w3,
                    max(d) filter (position = series_rows - 3) as w4, max(d) filter (position = series_rows - 2) as w5,
                    max(d) filter (position = series_rows - 1) as w6
             from changes group by 1, 2, 3),
    steps as (select t.location_id, location_name, city, last_date, y, sigma, rmse,
                     a * c0 + b * w1 as f1, a * f1 + b * w2 as f2, a * f2 + b * w3 as f3, a * f3 + b * w4 as f4,
                     a * f4 + b * w5 as f5, a * f5 + b * w6 as f6, a * f6 + b * c0 as f7
              from tail t join weights w on w.location_id = t.location_id and w.part = 'all'
                          join spread on spread.location_id = t.location_id join errors on errors.location_id = t.location_id),
    path as (select *, unnest([1, 2, 3, 4, 5, 6, 7]) as h,
                    unnest([y + f1, y + f1 + f2, y + f1 + f2 + f3, y + f1 + f2 + f3 + f4, y + f1 + f2 + f3 + f4 + f5,
                            y + f1 + f2 + f3 + f4 + f5 + f6, y + f1 + f2 + f3 + f4 + f5 + f6 + f7]) as mean from steps)"""
FITTED_SQL = f"""
    with eligible as ({ELIGIBLE_SQL}), {CHANGES}
    select location_id, location_name, city, last_date + h as forecast_date, round(greatest(mean, 0), 4) as forecast_pm25,
           {index_sql('greatest(mean, 0)', C.PM25_BANDS)} as forecast_aqi,
           {aqi_category_sql(index_sql('greatest(mean, 0)', C.PM25_BANDS))} as forecast_aqi_category,
           round(greatest(mean - 1.96e0 * sigma * sqrt(h), 0), 4) as ci_lower_95,
           round(greatest(mean + 1.96e0 * sigma * sqrt(h), 0), 4) as ci_upper_95, round(rmse, 4) as holdout_rmse,
           '{AS_OF}' as generated_at, 'lagdiff' as model
    from path"""
register(
    "fitted_forecast_fc03_m18",
    lambda i: forecast.model_forecasts(_fitted(i), AS_OF.isoformat(), "lagdiff"),
    FITTED_SQL,
)
register(
    "forecast_run_fc08_snk03",
    lambda i: forecast_job.run_forecasts(
        i.spark, i.series, shared_folder(i.spark, "forecast"), AS_OF
    )[1],
    f"""select cast((select count(distinct location_id) from pm25_days) as bigint) as stations_ok, cast(0 as bigint) as errors,
               count(*) as records, count(*) filter (forecast_aqi > 150) as alert_count from ({FITTED_SQL}) f""",
)

# A day's only run: its forecasts are the rows of the accuracy table.
register(
    "run_checks_dq16_snk06_snk07",
    _daily_run,
    _checks_sql()
    + "\nunion all select 'not_null_mart_feature_stats_location_id', count(*) from (select location_id from features group by 1) where location_id is null"
    + "\nunion all select 'unique_mart_feature_stats', count(*) from (select location_id from (select location_id from features group by 1) group by 1 having count(*) > 1)"
    + "".join(
        f"\nunion all select 'not_null_mart_forecast_accuracy_{column}', count(*) from ({FITTED_SQL}) f where {column} is null"
        for column in quality.GRAINS["mart_forecast_accuracy"]
    )
    + f"""
       union all select 'unique_mart_forecast_accuracy', count(*)
       from (select 1 from ({FITTED_SQL}) f group by location_id, model, forecast_date having count(*) > 1)
       union all select 'accepted_model', count(*) from ({FITTED_SQL}) f where model <> 'lagdiff'""",
)

# Sources -----------------------------------------------------------------------------


def _archive(i: Inputs) -> str:
    """The archive as the reader expects it: gzip text under station, year and month folders."""
    path = shared_folder(i.spark, "archive")
    folders = ["locationid", "year", "month"]
    options = {"header": True, "compression": "gzip", "quoteAll": True}
    with writers.write_sizing(i.spark, writers.FOLDER_SIZING):
        i.measurements_raw.hint("rebalance", *folders).write.partitionBy(*folders).options(**options).csv(path)
    return path


register(
    "read_measurements_src01",
    lambda i: staging.stage_measurements(files.read_measurements(i.spark, _archive(i))),
    "select * from stg",
)
register(
    "backfill_src12",
    lambda i: files.backfill(i.spark, _archive(i), years=[1996, 1997], stations=[3, 7, 23])
    .groupBy("locationid", "year", "month")
    .agg(F.count(F.lit(1)).alias("n_rows")),
    """select cast(folder_station as varchar) as locationid, year, month, count(*) as n_rows from raw
       where year in ('1996', '1997') and folder_station in (3, 7, 23) group by 1, 2, 3""",
)


def _flat_weather(i: Inputs) -> str:
    path = shared_folder(i.spark, "weather")
    i.weather_raw.write.json(path)
    return path


def _weather_files(i: Inputs) -> str:
    path = shared_folder(i.spark, "weather")
    writers.write_weather_landing(i.weather_raw, path)
    return path


register(
    "read_weather_src03",
    lambda i: staging.stage_weather(files.read_weather(i.spark, _flat_weather(i))),
    "select * from stg_weather",
)
register(
    "weather_landing_days_snk05",
    lambda i: staging.stage_weather(files.read_weather(i.spark, _weather_files(i)).where("day between '1997-03-01' and '1997-03-31'")),
    "select * from stg_weather where measurement_date between date '1997-03-01' and date '1997-03-31'",
)


def _station_file(i: Inputs) -> str:
    path = shared_folder(i.spark, "stations")
    i.stations.write.option("header", True).csv(path)
    return path


register(
    "read_stations_src04",
    lambda i: files.read_stations(i.spark, _station_file(i)),
    """select location_id, location_name, city, province, station_lat as latitude, station_lon as longitude, sensor_type,
              is_outlier_station from stations""",
)
register(
    "holiday_readings_src05",
    lambda i: i.stg.join(i.holidays, F.col("measurement_date") == F.col("holiday_date"))
    .groupBy("holiday_date", "holiday_name", "is_tet_period")
    .agg(F.count(F.lit(1)).alias("readings")),
    """select holiday_date, holiday_name, is_tet_period, count(*) as readings
       from stg join holidays on measurement_date = holiday_date group by 1, 2, 3""",
)


def _stored_forecasts(i: Inputs) -> DataFrame:
    """Two runs, the first one written twice: the second write replaces its folders only."""
    path = shared_folder(i.spark, "forecasts")
    earlier = i.next_week.withColumn("generated_at", F.lit("2001-10-28"))
    writers.write_forecasts(earlier.withColumn("forecast_pm25", F.lit(0.0)), path)
    writers.write_forecasts(i.next_week, path)
    writers.write_forecasts(earlier, path)
    return files.read_forecasts(i.spark, path)


register(
    "read_forecasts_src06_snk03",
    _stored_forecasts,
    "select * from next_week union all select * replace ('2001-10-28' as generated_at) from next_week",
)


def _hourly_payloads(i: Inputs) -> DataFrame:
    """Answers of at most a hundred hours of one station."""
    hours = F.struct(
        F.concat("date", F.lit("T"), F.lpad(F.col("hour_utc").cast("string"), 2, "0"), F.lit(":00")).alias("time"),
        *[F.col(column).alias(name) for name, column in payloads.HOURLY_FIELDS.items()],
    )
    numbered = i.weather_source.selectExpr(*WEATHER_RAW, "o_orderkey div 100 as part")
    answers = numbered.groupBy("location_id", "part").agg(F.collect_list(hours).alias("hours"))
    arrays = F.struct(*[F.col(f"hours.{name}").alias(name) for name in ["time", *payloads.HOURLY_FIELDS]])
    text = F.to_json(F.struct(arrays.alias("hourly")), {"ignoreNullFields": "false"})
    return answers.select("location_id", text.alias("payload"))


register(
    "explode_hourly_src07",
    # The dates asked for are the days that have readings.
    lambda i: payloads.explode_hourly(_hourly_payloads(i), i.stg.select(F.col("measurement_date").alias("date"))),
    """select location_id, strftime(date, '%Y-%m-%d') as date, hour_utc, temperature_2m, rh_2m, wind_speed, wind_dir,
              precipitation_mm, surface_pressure_hpa, boundary_layer_height_m
       from weather_raw where date in (select measurement_date from stg)""",
)


def _station_payloads(i: Inputs) -> DataFrame:
    """Station answers with at most fifty sensors each; every ninth sensor has no id."""
    sensor = F.struct(
        F.expr("if(s_suppkey % 9 = 0, null, s_suppkey)").alias("id"),
        F.struct(
            F.expr("if(s_suppkey % 2 = 0, 'pm25', 'pm10')").alias("name"), F.lit("ug/m3").alias("units")
        ).alias("parameter"),
    )
    grouped = (
        i.table("supplier")
        .groupBy(F.col("s_nationkey").alias("location_id"), F.expr("s_suppkey div 50").alias("part"))
        .agg(F.collect_list(sensor).alias("sensors"))
    )
    station = F.struct(
        F.concat(F.lit("place "), F.col("location_id").cast("string")).alias("name"),
        F.struct(
            F.col("location_id").cast("double").alias("latitude"), F.lit(105.0).alias("longitude")
        ).alias("coordinates"),
        "sensors",
    )
    return grouped.select("location_id", F.to_json(F.struct(F.array(station).alias("results"))).alias("payload"))


register(
    "sensor_lookup_src08",
    lambda i: payloads.sensor_lookup(_station_payloads(i)),
    """select s_suppkey as sensor_id, case when s_suppkey % 2 = 0 then 'pm25' else 'pm10' end as parameter, 'ug/m3' as units,
              'place ' || s_nationkey as location_name, s_nationkey::double as lat, 105e0 as lon, s_nationkey as location_id
       from supplier where s_suppkey % 9 <> 0""",
)


def _latest_payloads(i: Inputs) -> DataFrame:
    """Answers of at most fifty readings; the time comes as an object or as text."""
    moment = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    as_object = F.to_json(F.struct(moment.alias("utc")))
    reading = F.concat(
        F.lit('{"datetime":'), F.when(F.col("event_id") % 2 == 0, as_object).otherwise(F.concat(F.lit('"'), moment, F.lit('"'))),
        F.when(F.col("event_id") % 11 == 0, F.lit("")).otherwise(F.concat(F.lit(',"value":'), (F.col("event_id") % 400).cast("string"))),
        F.lit(',"sensorsId":'), (F.col("user_id") + 1).cast("string"),
        F.when(F.col("event_id") % 3 == 0, F.lit(',"coordinates":{"latitude":0.0,"longitude":106.5}')).otherwise(F.lit("")),
        F.lit("}"),
    )
    grouped = (
        i.table("events")
        .groupBy(F.expr("event_id div 50").alias("part"))
        .agg(F.array_join(F.collect_list(reading), ",").alias("readings"))
    )
    return grouped.select(
        (F.col("part") % 21).alias("location_id"),
        F.concat(F.lit('{"results":['), F.col("readings"), F.lit("]}")).alias("payload"),
    )


register(
    "flatten_latest_src09_jn09",
    lambda i: payloads.flatten_latest(
        _latest_payloads(i), payloads.sensor_lookup(_station_payloads(i)), F.lit("2024-01-30T00:00:00+00:00")
    ),
    """select (event_id // 50) % 21 as location_id, user_id + 1 as sensors_id,
              coalesce('place ' || s_nationkey, '') as location, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as datetime,
              cast(s_nationkey as double) as lat, case when event_id % 3 = 0 then 106.5e0 when s_suppkey is not null then 105e0 end as lon,
              case when s_suppkey is null then '' when s_suppkey % 2 = 0 then 'pm25' else 'pm10' end as parameter,
              case when s_suppkey is null then '' else 'ug/m3' end as units,
              case when event_id % 11 = 0 then -999e0 else cast(event_id % 400 as double) end as value,
              '2024-01-30T00:00:00+00:00' as ingested_at
       from events left join (select * from supplier where s_suppkey % 9 <> 0) s on s.s_suppkey = user_id + 1""",
)


def _listing(i: Inputs) -> DataFrame:
    return i.table("documents").selectExpr(
        "concat('file-', cast(doc_id as string)) as path", "cast(n_chars as string) as etag",
        "cast(doc_id % 21 as int) as station_id",
    )


def _ledger(i: Inputs) -> DataFrame:
    """Even files are known, some with an older etag; odd entries are files no longer listed."""
    return i.table("documents").selectExpr(
        "concat(if(doc_id % 2 = 0, 'file-', 'gone-'), cast(doc_id as string)) as path",
        "cast(if(doc_id % 10 = 0, n_chars + 1, n_chars) as string) as etag",
    )


register(
    "incremental_ingest_src10",
    lambda i: incremental.new_or_changed(_listing(i), _ledger(i)),
    """select 'file-' || doc_id as path, cast(n_chars as varchar) as etag, cast(doc_id % 21 as int) as station_id
       from documents where doc_id % 2 = 1 or doc_id % 10 = 0""",
)
def _ingested(i: Inputs) -> DataFrame:
    """Files spread over twelve months, of which the last six are looked at; some copies time out."""
    ids = F.expr("cast(substring(path, 6) as bigint)")
    listing = _listing(i).withColumn("month_start", F.expr(f"add_months(trunc(date '{LIVE_AS_OF}', 'MM'), -cast(cast(substring(path, 6) as bigint) % 12 as int))"))
    outcomes = _listing(i).select("path", F.when(ids % 97 == 0, "timeout").alias("error"))
    return incremental.ingest_summary(listing, _ledger(i), outcomes=outcomes, window=(LIVE_AS_OF, 6))


register(
    "ingest_summary_src10",
    _ingested,
    f"""select cast(doc_id % 21 as int) as station_id, count(*) filter (fresh and doc_id % 97 <> 0) as copied,
               count(*) filter (not fresh) as skipped, count(*) filter (fresh and doc_id % 97 = 0) as failed,
               max(case when fresh and doc_id % 97 = 0 then 'timeout' end) as error
        from (select *, doc_id % 2 = 1 or doc_id % 10 = 0 as fresh from documents where doc_id % 12 < 6) group by 1""",
)
register(
    "ledger_after_ingest_src10",
    lambda i: incremental.updated_ledger(_listing(i), _ledger(i)),
    """select 'file-' || doc_id as path, cast(n_chars as varchar) as etag from documents
       union all select 'gone-' || doc_id, cast(n_chars as varchar) from documents where doc_id % 2 = 1""",
)
register(
    "weather_backfill_src13",
    lambda i: incremental.weather_backfill(
        i.stg_weather, i.stg_weather.agg(F.max("measurement_date").alias("as_of")), 30
    ).select("location_id", "measurement_date", "hour_utc", "temperature_2m"),
    """select location_id, measurement_date, hour_utc, temperature_2m from stg_weather
       where measurement_date >= (select max(measurement_date) from stg_weather) - 30
         and measurement_date < (select max(measurement_date) from stg_weather)""",
)
register(
    "missing_weather_days_src13",
    lambda i: incremental.missing_weather_days(i.stg_weather, i.stations, F.lit(AS_OF), 365),
    f"""select location_id, d.measurement_date
        from stations, (select cast(unnest(generate_series(date '{AS_OF}' - 365, date '{AS_OF}' - 1, interval 1 day)) as date) as measurement_date) d
        where not exists (select 1 from stg_weather w where w.location_id = stations.location_id and w.measurement_date = d.measurement_date)""",
)

# Sinks and streams -------------------------------------------------------------------


def _written(i: Inputs, frame: DataFrame, *folders: str) -> DataFrame:
    path = shared_folder(i.spark, "table")
    writers.write_table(frame, path, folders)
    return i.spark.read.schema(frame.schema).parquet(path)


def _by_month(i: Inputs, frame: DataFrame, day: str) -> DataFrame:
    path = shared_folder(i.spark, "table")
    writers.write_months(frame, path, day)
    return writers.read_months(i.spark, frame, path).drop(writers.MONTH)


register("table_by_month_snk01", lambda i: _by_month(i, i.daily_weather, "measurement_date"), "select * from daily_weather")
register("plain_table_snk02", lambda i: _written(i, i.health), "select * from health")


def _landed(i: Inputs) -> dict[str, str]:
    """Drain the live stream into landing files, error files and metrics."""
    root = shared_folder(i.spark, "live")
    paths = {name: f"{root}/{name}" for name in ("valid", "errors", "metrics")}
    arrival = F.to_timestamp("ingested_at")
    query = live.land_live(
        i.live_stream(), paths["valid"], paths["errors"], f"{root}/checkpoint", paths["metrics"], arrival, once=True
    )
    query.awaitTermination()
    return paths


LIVE_SQL = """select location_id, sensors_id, parameter, value, strftime(local_moment, '%Y-%m-%dT%H:%M:%S+07:00') as datetime,
                     cast(year(local_moment) as int) as arrival_year, cast(month(local_moment) as int) as arrival_month,
                     cast(day(local_moment) as int) as arrival_day, cast(hour(local_moment) as int) as arrival_hour
              from judged where reason = ''"""
register(
    "live_landing_str01_str04_snk04_src02",
    lambda i: files.read_stream_landing(i.spark, _landed(i)["valid"]).select(
        "location_id", "sensors_id", "parameter", "value", "datetime",
        "arrival_year", "arrival_month", "arrival_day", "arrival_hour",
    ),
    LIVE_SQL,
)
register(
    "live_rejections_str02",
    lambda i: i.spark.read.schema(f"{schemas.STREAM_RAW}, reason string")
    .json(_landed(i)["errors"])
    .select("sensors_id", "parameter", "value", "reason"),
    "select sensors_id, parameter, value, reason from judged where reason <> ''",
)
register(
    "live_metrics_str07",
    lambda i: i.spark.read.parquet(_landed(i)["metrics"]).groupBy("parameter").agg(F.sum("rejected").alias("rejected")),
    """select case parameter when '' then 'unknown' else parameter end as parameter, count(*) as rejected
       from judged where reason <> '' group by 1""",
)


def _enriched_stream(i: Inputs) -> DataFrame:
    """Live readings joined to the sensor lookup inside the stream, then landed and read back."""
    root = shared_folder(i.spark, "live")
    readings = i.live_stream().withColumns({"sensors_id": F.col("location_id") + 1, "parameter": F.lit("")})
    sensors = payloads.sensor_lookup(_station_payloads(i))
    query = live.land_live(
        live.enrich_live(readings, sensors), f"{root}/valid", f"{root}/errors", f"{root}/checkpoint",
        arrival=F.to_timestamp("ingested_at"), once=True,
    )
    query.awaitTermination()
    return files.read_stream_landing(i.spark, f"{root}/valid").select(
        "location_id", "sensors_id", "location", "lat", "parameter", "units", "value"
    )


register(
    "live_enrichment_str03",
    _enriched_stream,
    """select l.location_id, l.location_id + 1 as sensors_id, coalesce('place ' || s_nationkey, l.location) as location,
              cast(s_nationkey as double) as lat,
              case when s_suppkey is null then '' when s_suppkey % 2 = 0 then 'pm25' else 'pm10' end as parameter, 'ug/m3' as units, value
       from live l left join (select * from supplier where s_suppkey % 9 <> 0) s on s.s_suppkey = l.location_id + 1
       where value >= 0 and value < 500""",
)


def _restarted(i: Inputs) -> DataFrame:
    """JSON files streamed in two runs with one checkpoint: what came in between is added once, nothing twice.

    Each row says in how many files of its hour and batch its station lies.
    """
    root = shared_folder(i.spark, "live")
    for half in (0, 1):
        i.live.where(F.col("sensors_id") % 2 == half).write.mode("append").json(f"{root}/in")
        stream = live.read_live(i.spark, f"{root}/in")
        live.land_live(stream, f"{root}/valid", f"{root}/errors", f"{root}/checkpoint", arrival=F.to_timestamp("ingested_at"), once=True).awaitTermination()
    landed = i.spark.read.schema(f"{schemas.STREAM_RAW}, {files.LANDING_HOURS}").json(f"{root}/valid")
    return (
        landed.select("location_id", "sensors_id", "y", "m", "d", "h", "batch", F.col("_metadata.file_path").alias("file"))
        .groupBy("location_id", "y", "m", "d", "h", "batch")
        .agg(F.count("*").alias("readings"), F.countDistinct("file").alias("files"))
        .groupBy("location_id").agg(F.sum("readings").alias("readings"), F.max("files").alias("files"))
    )


register(
    "live_restart_str01_str05_str06",
    _restarted,
    "select location_id, count(*) as readings, cast(1 as bigint) as files from judged where reason = '' group by 1",
)


def _holiday_file(i: Inputs) -> DataFrame:
    """The holiday seed as a file with unreadable lines, read back and joined to readings."""
    path = shared_folder(i.spark, "holidays")
    bad = i.spark.sql("select * from values ('not a date', 'Nothing', '1'), ('1998-13-40', 'Never', 'x') as t(date, holiday_name, is_tet_period)")
    i.holidays_raw.union(bad).coalesce(1).write.option("header", True).csv(path)
    holidays = files.typed_holidays(files.read_holidays(i.spark, path))
    joined = i.stg.join(holidays, F.col("measurement_date") == F.col("holiday_date"))
    return joined.groupBy("holiday_date", "holiday_name", "is_tet_period").agg(F.count("*").alias("n_rows"))


register(
    "read_holidays_src05",
    _holiday_file,
    """select holiday_date, holiday_name, is_tet_period, count(*) as n_rows
       from stg join holidays on measurement_date = holiday_date group by 1, 2, 3""",
)
