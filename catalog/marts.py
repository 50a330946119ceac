"""Registered staging, marts, joins, aggregates, windows and functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from airsift.functions import aqi, calendar, rules, stats
from airsift.functions import constants as C
from airsift.functions import weather as wx
from airsift.operators import city, daily, features, forecast, quality, staging
from catalog.inputs import AS_OF, Inputs
from catalog.oracle_ctes import aqi_category_sql, corr_sql, index_sql, pm10_category_sql, pm25_category_sql, season_sql
from catalog.registry import register

DAYS = ["location_id", "measurement_date"]

# Staging and marts -------------------------------------------------------------------

register("stg_measurements_m01_prj01", lambda i: i.stg_from_text, "select * from stg")
register("typed_staging_m01", lambda i: i.stg, "select * from stg")
register("stg_weather_m02_prj06", lambda i: i.stg_weather, "select * from stg_weather")
register("int_measurements_enriched_m03_jn01", lambda i: i.enriched, "select * from enriched")
register("int_weather_enriched_m04_jn02", lambda i: i.weather_enriched, "select * from weather_enriched")
register("mart_daily_air_quality_m05", lambda i: i.daily_aq, "select * from daily_aq")
register("mart_daily_aqi_m06", lambda i: i.daily_aqi, "select * from daily_aqi")
register("mart_daily_weather_m07", lambda i: i.daily_weather, "select * from daily_weather")
register("mart_aq_weather_daily_m08_jn05", lambda i: i.aq_weather, "select * from aq_weather")
register("mart_lagged_features_m09", lambda i: i.features, "select * from features")
register("mart_health_summary_m11", lambda i: i.health, "select * from health")
register("mart_exceedance_stats_m12", lambda i: i.exceedance, "select * from exceedance")
register("mart_annual_monthly_trend_m13", lambda i: i.trend, "select * from trend")
register("mart_monthly_profile_m14", lambda i: i.monthly, "select * from monthly")
register("mart_diurnal_profile_m15", lambda i: i.diurnal, "select * from diurnal")
register("mart_pollutant_ratio_m16", lambda i: i.ratio, "select * from ratio")
register("mart_forecast_accuracy_m17", lambda i: i.accuracy, "select * from accuracy")


def _feature_stats_sql() -> str:
    nulls = ", ".join(
        f"count(*) filter ({column} is null) as {key}_nulls" for key, column in features.COUNTED_NULLS.items()
    )
    today = ", ".join(
        f"{corr_sql(column, 'avg_pm25')} as corr_{key}_pm25" for key, column in features.CORRELATED_WITH_TODAY.items()
    )
    following = ", ".join(
        f"{corr_sql(column, 'pm25_next1')} as corr_{key}_next" for key, column in features.CORRELATED_WITH_NEXT.items()
    )
    return f"""
        select location_id, city, location_name, count(*) as total_rows, count(avg_pm25) as non_null_pm25,
               count(pm25_next1) as non_null_target, {nulls}, {today}, {following},
               round(avg(avg_pm25), 2) as mean_pm25, round(quantile_disc(avg_pm25, 0.5), 2) as median_pm25,
               round(stddev_samp(avg_pm25), 2) as stddev_pm25, round(min(avg_pm25), 2) as min_pm25,
               round(max(avg_pm25), 2) as max_pm25, min(measurement_date) as series_start,
               max(measurement_date) as series_end
        from features group by 1, 2, 3"""


register("mart_feature_stats_m10", lambda i: i.feature_stats, _feature_stats_sql())

# Projections and predicates ----------------------------------------------------------


def _raw_typed(i: Inputs):
    return staging._parsed_measurements(i.measurements_raw)


register(
    "reject_predicate_prj02",
    lambda i: _raw_typed(i)
    .withColumn(
        "accepted",
        F.coalesce(
            rules.archive_row_accepted(
                F.col("location_id"), F.col("measured_at"), F.col("parameter"), F.col("measurement_value")
            ),
            F.lit(False),
        ),
    )
    .groupBy("accepted")
    .agg(F.count(F.lit(1)).alias("n_rows")),
    """select location_id is not null and measured_at is not null and value is not null and value >= 0
              and not (parameter = 'pm25' and value >= 500) is true as accepted, count(*) as n_rows
       from (select * replace (coalesce(value, -1) as value) from raw) group by 1""",
)
register(
    "pm25_ceiling_prj03",
    lambda i: _raw_typed(i)
    .where(rules.over_pm25_ceiling(F.col("parameter"), F.col("measurement_value")))
    .groupBy("location_id", "parameter")
    .agg(F.count(F.lit(1)).alias("n_rows")),
    """select location_id, parameter, count(*) as n_rows from raw
       where parameter = 'pm25' and (value >= 500 or not_a_number) group by 1, 2""",
)
register(
    "casts_prj04",
    lambda i: _raw_typed(i).select("location_id", "sensor_id", "lat", "lon", F.when(~F.isnan("measurement_value"), F.col("measurement_value")).alias("measurement_value")),
    "select location_id, sensor_id, 20e0 + folder_station as lat, 105e0 + folder_station as lon, value as measurement_value from raw",
)
register(
    "iso_timestamps_prj05",
    lambda i: _raw_typed(i).select("sensor_id", "measured_at", "measurement_date"),
    "select sensor_id, measured_at, cast(measured_at as date) as measurement_date from raw",
)
register(
    "validate_readings_prj07",
    lambda i: staging.split_live_readings(i.live).select("sensors_id", "parameter", "value", "is_valid", "reason"),
    "select sensors_id, parameter, value, reason = '' as is_valid, reason from judged",
)
register(
    "rejection_counts_prj08",
    lambda i: staging.rejection_counts(i.live),
    """select case parameter when '' then 'unknown' else parameter end as parameter, count(*) as rejected
       from judged where reason <> '' group by 1""",
)
register(
    "known_parameters_prj09",
    lambda i: i.live.groupBy("parameter").agg(
        F.first(rules.known_parameter(F.col("parameter"))).alias("known_live"),
        F.first(F.col("parameter").isin(C.KNOWN_STAGED_PARAMETERS)).alias("known_staged"),
    ),
    """select distinct parameter, parameter in ('pm25', 'pm10', 'o3') as known_live,
              parameter in ('pm25', 'pm10', 'o3') as known_staged from live""",
)
register(
    "trusted_stations_prj10",
    lambda i: daily.trusted(i.daily_aq).select(*DAYS, "parameter", "avg_value"),
    "select location_id, measurement_date, parameter, avg_value from daily_aq where is_outlier_station <> 1",
)

# Joins -------------------------------------------------------------------------------

register(
    "daily_with_humidity_jn03",
    lambda i: i.daily_aq.where("sensor_type = 'low_cost' and parameter = 'pm25'").select(*DAYS, "avg_value", "corrected_pm25"),
    "select location_id, measurement_date, avg_value, corrected_pm25 from daily_aq where sensor_type = 'low_cost' and parameter = 'pm25'",
)
register(
    "dominant_pollutant_jn04_agg06",
    lambda i: i.daily_aqi.groupBy("location_id", "dominant_pollutant").agg(F.count(F.lit(1)).alias("days")),
    """select location_id, dominant_pollutant, count(*) as days from daily_aqi group by 1, 2""",
)
register(
    "holiday_join_jn06",
    lambda i: features.flag_holidays(
        i.aq_weather.select("location_id", "measurement_date"), i.holidays
    ),
    """select location_id, measurement_date,
              cast(measurement_date in (select holiday_date from holidays) as int) as is_holiday,
              cast(measurement_date in (select holiday_date from holidays where is_tet_period = 1) as int) as is_tet_period
       from aq_weather""",
)
register(
    "forecast_actuals_jn07",
    lambda i: i.accuracy.select("location_id", "model", "forecast_date", "forecast_pm25", "actual_pm25"),
    """select n.location_id, n.model, n.forecast_date, n.forecast_pm25, p.avg_value as actual_pm25
       from newest_runs n left join pm25_days p on p.location_id = n.location_id and p.measurement_date = n.forecast_date""",
)
register(
    "orphan_rows_jn10_dq05",
    lambda i: quality.orphans(
        i.stg.select("location_id", "sensor_id", "parameter"), i.stations, "location_id"
    ).groupBy("location_id").agg(F.count(F.lit(1)).alias("n_rows")),
    """select location_id, count(*) as n_rows from stg
       where location_id not in (select location_id from stations) group by 1""",
)
register(
    "composite_is_maximum_jn12_dq11",
    lambda i: quality.composite_is_not_maximum(
        # Shifted on days ending in 5, so that the check has rows to find.
        i.daily_aqi.withColumn(
            "composite_aqi",
            F.when(F.day("measurement_date") % 10 == 5, F.col("composite_aqi") + 1).otherwise(F.col("composite_aqi")),
        ),
        i.daily_aq,
    ),
    """select measurement_date, location_id, composite_aqi + 1 as composite_aqi, composite_aqi as expected_composite
       from daily_aqi where day(measurement_date) % 10 = 5""",
)

# Aggregations ------------------------------------------------------------------------

register(
    "station_day_aggregates_agg01",
    lambda i: i.daily_aq.select(*DAYS, "parameter", "avg_value", "max_value", "min_value", "reading_count"),
    "select location_id, measurement_date, parameter, avg_value, max_value, min_value, reading_count from daily_base",
)
register(
    "distinct_counts_agg02",
    # Duplicates go first, map-side: counting several columns distinctly multiplies the rows.
    lambda i: i.stg.select("parameter", "sensor_id", "measurement_date", "location_id")
    .distinct()
    .groupBy("parameter")
    .agg(
        F.count_distinct("sensor_id").alias("sensors"),
        F.count_distinct("measurement_date").alias("days"),
        F.count_distinct("location_id").alias("stations_seen"),
    ),
    """select parameter, count(distinct sensor_id) as sensors, count(distinct measurement_date) as days,
              count(distinct location_id) as stations_seen from stg group by 1""",
)
register(
    "conditional_pivot_agg03",
    lambda i: i.daily_aq.groupBy(*DAYS).pivot("parameter", ["pm25", "pm10", "relativehumidity"]).agg(F.max("avg_value")),
    """select location_id, measurement_date, max(case when parameter = 'pm25' then avg_value end) as pm25,
              max(case when parameter = 'pm10' then avg_value end) as pm10,
              max(case when parameter = 'relativehumidity' then avg_value end) as relativehumidity
       from daily_base group by 1, 2""",
)
register(
    "count_if_agg04_rate_agg05",
    lambda i: daily.trusted_pm25(i.daily_aq).groupBy("city").agg(
        F.count_if(F.col("avg_value") > 15).alias("over_who"),
        F.count_if(F.col("avg_value") > 50).alias("over_national"),
        stats.rate_percent(F.col("avg_value") > 50).alias("national_rate"),
    ),
    """select city, sum(case when avg_value > 15 then 1 else 0 end)::bigint as over_who,
              sum(case when avg_value > 50 then 1 else 0 end)::bigint as over_national,
              round(100e0 * sum(case when avg_value > 50 then 1 else 0 end) / count(*), 1) as national_rate
       from pm25_days group by 1""",
)
register(
    "percentiles_agg07",
    lambda i: i.stg.groupBy("location_id", "parameter").agg(
        stats.percentile(F.col("measurement_value"), 0.5).alias("median"),
        stats.percentile(F.col("measurement_value"), 0.95).alias("p95"),
    ),
    """select location_id, parameter, quantile_disc(measurement_value, 0.5) as median,
              quantile_disc(measurement_value, 0.95) as p95 from stg group by 1, 2""",
)
register(
    "correlations_agg08_stddev_agg09_nulls_agg10",
    lambda i: i.aq_weather.groupBy("location_id").agg(
        F.round(stats.safe_corr(F.col("avg_rh_2m"), F.col("avg_pm25")), 4).alias("corr_rh"),
        F.round(stats.safe_corr(F.col("inversion_risk").cast("double"), F.col("avg_pm25")), 4).alias("corr_inversion"),
        # A constant series has no correlation.
        F.round(stats.safe_corr(F.col("avg_rh_2m") * 0, F.col("avg_pm25")), 4).alias("corr_constant"),
        F.round(F.stddev_samp("avg_pm25"), 4).alias("spread"),
        stats.null_count(F.col("avg_rh_2m")).alias("rh_nulls"),
        F.min("measurement_date").alias("first_day"),
        F.max("measurement_date").alias("last_day"),
    ),
    f"""select location_id, {corr_sql('avg_rh_2m', 'avg_pm25')} as corr_rh,
               {corr_sql('inversion_risk', 'avg_pm25')} as corr_inversion, cast(null as double) as corr_constant,
               round(stddev_samp(avg_pm25), 4) as spread, count(*) - count(avg_rh_2m) as rh_nulls,
               min(measurement_date) as first_day, max(measurement_date) as last_day
        from aq_weather group by 1""",
)
register(
    "circular_mean_agg11_rain_agg12",
    lambda i: i.stg_weather.groupBy("measurement_date").agg(
        F.round(wx.circular_mean(F.col("wind_dir")), 2).alias("direction"),
        F.round(F.sum("precipitation_mm"), 4).alias("rain"),
        wx.calm_hours(F.col("wind_speed")).alias("calm"),
    ),
    """select measurement_date,
              round((degrees(atan2(avg(sin(radians(wind_dir))), avg(cos(radians(wind_dir))))) + 360e0) % 360e0, 2) as direction,
              round(sum(precipitation_mm), 4) as rain, count(*) filter (wind_speed < 2) as calm
       from stg_weather group by 1""",
)
register(
    "city_daily_agg13",
    lambda i: city.city_daily(i.daily_aq, ["city", "province"]).withColumn("pm25_city_avg", F.round("pm25_city_avg", 6)),
    "select city, province, measurement_date, year, month_of_year, round(mean, 6) as pm25_city_avg from city_days",
)
register(
    "series_bounds_agg15",
    lambda i: i.series.groupBy("location_id").agg(
        F.min("measurement_date").alias("series_start"), F.max("measurement_date").alias("series_end")
    ),
    "select location_id, min(measurement_date) as series_start, max(measurement_date) as series_end from pm25_days group by 1",
)

# Windows, sets, limits ---------------------------------------------------------------

register(
    "row_lags_win01_lead_win02_means_win03",
    lambda i: i.features.select(
        *DAYS, "pm25_lag1", "pm25_lag7", "pm25_lag30", "pm25_next1", "pm25_roll7", "pm25_roll30"
    ),
    """select location_id, measurement_date, lag(avg_pm25, 1) over w as pm25_lag1, lag(avg_pm25, 7) over w as pm25_lag7,
              lag(avg_pm25, 30) over w as pm25_lag30, lead(avg_pm25, 1) over w as pm25_next1,
              round(avg(avg_pm25) over (w rows 6 preceding), 4) as pm25_roll7,
              round(avg(avg_pm25) over (w rows 29 preceding), 4) as pm25_roll30
       from aq_weather window w as (partition by location_id order by measurement_date)""",
)
register("newest_run_win04", lambda i: forecast.latest_runs(i.forecasts), "select * from newest_runs")
register(
    "rolling_errors_win05_win06",
    lambda i: i.accuracy.where("actual_pm25 is not null").select(
        "location_id", "model", "forecast_date", "rolling_rmse_7d", "rolling_rmse_30d", "rolling_mae_30d", "rolling_bias_30d"
    ),
    """select location_id, model, forecast_date, rolling_rmse_7d, rolling_rmse_30d, rolling_mae_30d, rolling_bias_30d
       from accuracy where actual_pm25 is not null""",
)
register(
    "ordered_rows_srt01",
    lambda i: i.stations.orderBy("city", "location_id"),
    """select location_id, location_name, city, province, station_lat as latitude, station_lon as longitude,
              sensor_type, is_outlier_station from stations order by city, location_id""",
)
register(
    "observed_and_future_set01",
    lambda i: i.accuracy.where("actual_pm25 is not null")
    .select("location_id", "model", "forecast_date", "error")
    .unionByName(i.accuracy.where("actual_pm25 is null").select("location_id", "model", "forecast_date", F.lit(None).cast("double").alias("error"))),
    """select location_id, model, forecast_date, error from accuracy""",
)
register(
    "first_rows_lim01",
    lambda i: i.stg.select(*DAYS, "sensor_id", "parameter", "measured_at", "measurement_value")
    .orderBy(F.desc("measurement_value"), "measured_at", "location_id", "sensor_id", "parameter")
    .limit(5),
    """select location_id, measurement_date, sensor_id, parameter, measured_at, measurement_value from stg
       order by measurement_value desc, measured_at, location_id, sensor_id, parameter limit 5""",
)

# Scalar functions --------------------------------------------------------------------

# Eighths of the readings, so that values inside and between bands occur.
FINE_SQL = "(select sensor_id, measured_at, sensor_type, measurement_date, measurement_value / 8e0 as c from enriched)"


def _fine(i: Inputs):
    return i.enriched.select("sensor_id", "measured_at", "sensor_type", "measurement_date", (F.col("measurement_value") / 8.0).alias("c"))


register(
    "aqi_pm25_fn01",
    lambda i: _fine(i).select("sensor_id", "measured_at", "c", aqi.aqi_pm25(F.col("c")).alias("index")),
    f"select sensor_id, measured_at, c, {index_sql('c', C.PM25_BANDS)} as index from {FINE_SQL}",
)
register(
    "aqi_pm10_fn02",
    lambda i: _fine(i).select("sensor_id", "measured_at", "c", aqi.aqi_pm10(F.col("c")).alias("index")),
    f"select sensor_id, measured_at, c, {index_sql('c', C.PM10_BANDS)} as index from {FINE_SQL}",
)
register(
    "aqi_other_fn03",
    lambda i: i.daily_aq.groupBy("parameter").agg(F.count("aqi_value").alias("with_index"), F.count(F.lit(1)).alias("n_rows")),
    "select parameter, count(*) filter (parameter <> 'relativehumidity') as with_index, count(*) as n_rows from daily_base group by 1",
)
register(
    "aqi_category_fn04",
    lambda i: _fine(i).select(
        "sensor_id", "measured_at", "c",
        aqi.aqi_category(F.lit("pm25"), F.col("c")).alias("as_pm25"),
        aqi.aqi_category(F.lit("pm10"), F.col("c")).alias("as_pm10"),
    ),
    f"select sensor_id, measured_at, c, {pm25_category_sql('c')} as as_pm25, {pm10_category_sql('c')} as as_pm10 from {FINE_SQL}",
)
register(
    "category_from_index_fn05",
    lambda i: i.daily_aqi.select(*DAYS, aqi.category_from_aqi(F.col("composite_aqi")).alias("category")),
    f"select location_id, measurement_date, {aqi_category_sql('composite_aqi')} as category from daily_aqi",
)
register(
    "forecast_index_fn06",
    lambda i: i.accuracy.select("location_id", "model", "forecast_date", aqi.forecast_aqi(F.col("error")).alias("index")),
    f"""select location_id, model, forecast_date,
               case when error is null or error < 0 then 0 else {index_sql('error', C.PM25_BANDS)} end as index from accuracy""",
)
register(
    "limits_fn07_cigarettes_fn08_humidity_fn09",
    lambda i: i.daily_aq.select(
        *DAYS, "parameter", "exceeds_who_24h", "exceeds_qcvn", "who_compliant_day", "cigarette_equivalent", "corrected_pm25"
    ),
    """select location_id, measurement_date, parameter, exceeds_who_24h, exceeds_qcvn, who_compliant_day,
              cigarette_equivalent, corrected_pm25 from daily_aq""",
)
register(
    "weather_flags_fn10",
    lambda i: i.daily_weather.groupBy("inversion_risk", "wet_scavenging").agg(F.count(F.lit(1)).alias("days")),
    "select inversion_risk, wet_scavenging, count(*) as days from daily_weather group by 1, 2",
)
register(
    "particle_ratio_fn11",
    lambda i: i.ratio.groupBy("source_indicator").agg(F.count(F.lit(1)).alias("days"), F.count("pm25_pm10_ratio").alias("ratios")),
    "select source_indicator, count(*) as days, count(pm25_pm10_ratio) as ratios from ratio group by 1",
)
register(
    "risk_label_fn12",
    lambda i: i.trend.select(
        "city", "year", "month_of_year", aqi.compliance_risk(F.lit(100.0) - F.col("who_exceedance_rate")).alias("risk")
    ),
    """select city, year, month_of_year,
              case when 100e0 - who_exceedance_rate >= 80 then 'Low' when 100e0 - who_exceedance_rate >= 50 then 'Moderate'
                   when 100e0 - who_exceedance_rate >= 20 then 'High' else 'Extreme' end as risk from trend""",
)
register(
    "season_fn13_day_type_fn14_local_fn15",
    lambda i: i.stg.select(
        "sensor_id", "measured_at",
        calendar.local_time(F.col("measured_at")).alias("local_time"),
        F.hour(calendar.local_time(F.col("measured_at"))).alias("local_hour"),
        calendar.season(F.col("measurement_date")).alias("season"),
        calendar.day_type(F.col("measurement_date")).alias("day_type"),
        calendar.iso_weekday(F.col("measurement_date")).alias("weekday"),
    ),
    f"""select sensor_id, measured_at, measured_at + interval 7 hour as local_time,
               cast(hour(measured_at + interval 7 hour) as int) as local_hour, {season_sql('measurement_date')} as season,
               case when isodow(measurement_date) > 5 then 'Weekend' else 'Weekday' end as day_type,
               cast(isodow(measurement_date) as int) as weekday from stg""",
)
register(
    "month_circle_fn16",
    lambda i: i.features.select("measurement_date", "month_sin", "month_cos").distinct(),
    "select distinct measurement_date, month_sin, month_cos from features",
)
register(
    "wind_sector_fn17",
    lambda i: i.aq_weather.groupBy(wx.wind_sector(F.col("avg_wind_dir")).alias("sector")).agg(F.count(F.lit(1)).alias("days")),
    """select case when avg_wind_dir is null then 'Unknown' when avg_wind_dir < 90 then 'NE (0-90)'
                   when avg_wind_dir < 180 then 'SE (90-180)' when avg_wind_dir < 270 then 'SW (180-270)'
                   else 'NW (270-360)' end as sector, count(*) as days from aq_weather group by 1""",
)
register(
    "category_colour_fn19",
    lambda i: i.daily_aq.groupBy("aqi_category").agg(
        F.first(aqi.colour(F.col("aqi_category"))).alias("colour"), F.count(F.lit(1)).alias("n_rows")
    ),
    """select aqi_category, case aqi_category when 'Good' then '#00e400' when 'Moderate' then '#ffff00'
              when 'Unhealthy for Sensitive Groups' then '#ff7e00' when 'Unhealthy' then '#ff0000'
              when 'Very Unhealthy' then '#8f3f97' when 'Hazardous' then '#7e0023' else '#cccccc' end as colour,
              count(*) as n_rows from daily_aq group by 1""",
)
register(
    "forecast_errors_fn21",
    lambda i: i.accuracy.select("location_id", "model", "forecast_date", "error", "abs_error", "squared_error"),
    "select location_id, model, forecast_date, error, abs_error, squared_error from matched",
)
register(
    "data_age_fn22",
    lambda i: i.stg.groupBy("location_id").agg(F.date_diff(F.lit(AS_OF), F.max("measurement_date")).alias("age_days")),
    f"select location_id, cast(date '{AS_OF}' - max(measurement_date) as int) as age_days from stg group by 1",
)
register(
    "builtin_functions_fn23",
    lambda i: i.stg.select(
        "sensor_id", "measured_at",
        F.round(F.sqrt("measurement_value"), 6).alias("root"),
        F.pow("measurement_value", F.lit(2.0)).alias("square"),
        F.abs(F.lit(100.0) - F.col("measurement_value")).alias("distance"),
        (F.col("measurement_value") % 7.0).alias("remainder"),
        F.year("measured_at").alias("y"), F.month("measured_at").alias("m"), F.hour("measured_at").alias("h"),
        F.date_add("measurement_date", 7).alias("next_week_day"),
    ),
    """select sensor_id, measured_at, round(sqrt(measurement_value), 6) as root, measurement_value * measurement_value as square,
              abs(100 - measurement_value) as distance, measurement_value % 7e0 as remainder,
              cast(year(measured_at) as int) as y, cast(month(measured_at) as int) as m, cast(hour(measured_at) as int) as h,
              measurement_date + 7 as next_week_day from stg""",
)
register(
    "rounded_values_fn24",
    lambda i: i.daily_aqi.select(*DAYS, F.round("pm25_avg", 1).alias("pm25"), F.round("cigarette_equivalent", 1).alias("cigarettes")),
    "select location_id, measurement_date, round(pm25_avg, 1) as pm25, round(cigarette_equivalent, 1) as cigarettes from daily_aqi",
)
