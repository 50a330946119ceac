"""Registered serving queries, report datasets and ad-hoc checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from airsift.functions import stats
from airsift.operators import adhoc, reports, serving
from airsift.sources.incremental import month_window
from catalog.inputs import AS_OF, Inputs
from catalog.oracle_ctes import settled_sql
from catalog.registry import register

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

LATEST_SQL = f"""
    select * exclude (measurement_date, province), strftime(measurement_date, '%Y-%m-%d') as measurement_date
    from daily_aqi
    where date '{AS_OF}' - measurement_date <= {{days}}
    qualify row_number() over (partition by location_id order by daily_aqi.measurement_date desc) = 1"""

# Serving -----------------------------------------------------------------------------

register(
    "latest_station_aqi_srv01_jn08", lambda i: serving.latest_station_aqi(i.daily_aqi, AS_OF), LATEST_SQL.format(days=7)
)
register(
    "latest_station_aqi_long_srv01", lambda i: serving.latest_station_aqi(i.daily_aqi, AS_OF, 60), LATEST_SQL.format(days=60)
)


def _map_features(i: Inputs):
    """The document taken apart again, one row per feature."""
    document = serving.geojson(serving.latest_station_aqi(i.daily_aqi, AS_OF, 60))
    schema = (
        "type string, updated_at string, features array<struct<geometry: struct<type: string, coordinates: array<double>>, "
        "properties: struct<location_id: int, location_name: string, city: string, composite_aqi: int, "
        "health_category: string, dominant_pollutant: string, sensor_type: string, pm25_avg: double, "
        "cigarette_equivalent: double, measurement_date: string, colour: string>>>"
    )
    parsed = document.select(F.from_json("geojson", schema).alias("d"))
    feature = parsed.select("d.updated_at", F.explode("d.features").alias("f"))
    return feature.select(
        "updated_at",
        F.get("f.geometry.coordinates", F.lit(0)).alias("lon"),
        F.get("f.geometry.coordinates", F.lit(1)).alias("lat"),
        "f.properties.*",
    )


register(
    "geojson_srv02_prj12",
    _map_features,
    f"""select max(measurement_date) over () as updated_at, station_lon as lon, station_lat as lat, location_id,
               location_name, city, composite_aqi, health_category, dominant_pollutant, sensor_type,
               round(pm25_avg, 1) as pm25_avg, round(cigarette_equivalent, 1) as cigarette_equivalent, measurement_date,
               case health_category when 'Good' then '#00e400' when 'Moderate' then '#ffff00'
                    when 'Unhealthy for Sensitive Groups' then '#ff7e00' when 'Unhealthy' then '#ff0000'
                    when 'Very Unhealthy' then '#8f3f97' else '#7e0023' end as colour
        from ({LATEST_SQL.format(days=60)}) latest""",
)
register(
    "analytics_health_srv03",
    lambda i: serving.analytics_health(i.health),
    """select city, year, who_compliance_pct, avg_pm25, avg_cigarette_equivalent, good_days, moderate_days, usg_days,
              unhealthy_days, very_unhealthy_days, hazardous_days, risk_label from health""",
)


def _profile_sql(source: str, *keys: str) -> str:
    """Mean over trusted stations."""
    names = ", ".join(keys)
    return f"""select {names}, round(avg(avg_value), 1) as avg_pm25
               from {source} where parameter = 'pm25' and is_outlier_station = 0 and avg_value is not null group by all"""


MONTHLY_SQL = _profile_sql("monthly", "city", "month_of_year")
DIURNAL_SQL = _profile_sql("diurnal", "city", "hour_of_day", "day_type")
register("analytics_monthly_srv04_agg16", lambda i: serving.analytics_seasonal_monthly(i.monthly), MONTHLY_SQL)
register("analytics_diurnal_srv05", lambda i: serving.analytics_seasonal_diurnal(i.diurnal), DIURNAL_SQL)
register(
    "analytics_compliance_srv06",
    lambda i: serving.analytics_compliance(i.exceedance),
    """select city, year, month_of_year, who_exceedance_rate, qcvn_exceedance_rate, p95_pm25, avg_pm25 from exceedance""",
)
register(
    "analytics_forecast_srv07_jn11",
    lambda i: serving.analytics_forecast(i.forecasts, "snaive7"),
    """select location_name, city, cast(forecast_date as varchar) as forecast_date, forecast_pm25, forecast_aqi,
              forecast_aqi_category, ci_lower_95, ci_upper_95, holdout_rmse
       from forecasts where model = 'snaive7' qualify rank() over (order by generated_at desc) = 1""",
)
register(
    "typed_payload_prj11",
    lambda i: serving.typed_payload(
        i.measurements_raw.select(
            "sensors_id", F.coalesce("value", F.lit("")).alias("value"), F.col("value").alias("whole"),
            F.when(F.col("month") > "06", F.col("location")).otherwise(F.lit("")).alias("location"),
        ),
        integers=["sensors_id", "whole"],
        numbers=["value"],
    ).select("sensors_id", F.when(~F.isnan("value"), F.col("value")).alias("value"), "whole", "location"),
    """select sensor_id as sensors_id, value, cast(value as int) as whole,
              case when month > '06' then 'place ' || folder_station end as location from raw""",
)
register(
    "health_kpis_srv08_set03",
    lambda i: serving.health_kpis(i.health),
    """select city, year, who_compliance_pct, avg_pm25, avg_cigarette_equivalent, risk_label from health
       where year = (select max(year) from health)""",
)


def _pivot_sql(axis: str, measure: str, source: str) -> str:
    columns = ", ".join(f"""max({measure}) filter (city = '{name}') as "{name}" """ for name in REGIONS)
    return f"select {axis}, {columns} from ({source}) s group by 1"


register(
    "monthly_series_srv09",
    lambda i: serving.pivot_series(
        serving.analytics_seasonal_monthly(i.monthly), "month_of_year", "city", REGIONS, "avg_pm25"
    ),
    _pivot_sql("month_of_year", "avg_pm25", MONTHLY_SQL),
)
register(
    "weekday_hour_series_srv09",
    lambda i: serving.pivot_series(
        serving.analytics_seasonal_diurnal(i.diurnal).where("day_type = 'Weekday'"), "hour_of_day", "city", REGIONS, "avg_pm25"
    ),
    _pivot_sql("hour_of_day", "avg_pm25", f"select * from ({DIURNAL_SQL}) where day_type = 'Weekday'"),
)
register(
    "yearly_series_srv09",
    lambda i: serving.pivot_series(i.health, "year", "city", REGIONS, "who_compliance_pct"),
    _pivot_sql("year", "who_compliance_pct", "select * from health"),
)
register(
    "latest_compliance_series_srv09",
    lambda i: serving.pivot_series(
        serving.latest_year(i.exceedance), "month_of_year", "city", REGIONS, "who_exceedance_rate"
    ),
    _pivot_sql("month_of_year", "who_exceedance_rate", "select * from exceedance where year = (select max(year) from exceedance)"),
)
register(
    "axis_years_set02", lambda i: serving.axis_values(i.health, "year"), "select distinct year from health"
)
register(
    "forecast_kpis_srv10",
    lambda i: serving.forecast_kpis(i.next_week.where("model = 'mean7'")),
    """select round(avg(rmse), 1) as mean_rmse, count(*) as stations, cast(sum(high) as bigint) as high_aqi_days
       from (select location_name, min(holdout_rmse) as rmse, count(*) filter (forecast_aqi > 150) as high
             from next_week where model = 'mean7' group by 1)""",
)

# Reports -----------------------------------------------------------------------------




def _rounded(frame, digits: int = 6):
    """Doubles to a fixed number of places, so that the order of additions does not show."""
    return frame.select(
        *[stats.settled_round(F.col(name), digits).alias(name) if kind == "double" else F.col(name) for name, kind in frame.dtypes]
    )


def _report(name: str, query, keys: str, measures: list[str], source: str) -> None:
    columns = ", ".join(f"{settled_sql(f'avg({measure})', 6)} as {measure}" for measure in measures)
    register(name, lambda i: _rounded(query(i)), f"select {keys}, {columns} from {source} group by all")


register(
    "scorecard_srv11",
    lambda i: _rounded(reports.scorecard(i.health)),
    f"""select {settled_sql('avg(avg_cigarette_equivalent)', 6)} as avg_cigarette_equivalent,
              {settled_sql('avg(who_compliance_pct)', 6)} as who_compliance_pct, {settled_sql('avg(avg_pm25)', 6)} as avg_pm25,
              cast(sum(unhealthy_days) as bigint) as unhealthy_days, cast(sum(hazardous_days) as bigint) as hazardous_days from health""",
)
register(
    "health_days_by_city_srv11",
    lambda i: reports.health_days_by_city(i.health),
    "select city, " + ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in reports.DAY_COUNTS) + " from health group by 1",
)
_report("annual_trend_srv12", lambda i: reports.annual_trend(i.trend), "year, city", ["avg_pm25", "who_exceedance_rate"], "trend")
_report("pm25_by_inversion_srv13", lambda i: reports.pm25_by_inversion(i.aq_weather), "inversion_risk, city", ["avg_pm25"], "aq_weather")
_report("pm25_by_washout_srv13", lambda i: reports.pm25_by_washout(i.aq_weather), "wet_scavenging, city", ["avg_pm25"], "aq_weather")
_report("wind_and_pm25_srv14", lambda i: reports.wind_and_pm25(i.aq_weather), "city", ["avg_wind_speed", "avg_pm25"], "aq_weather")
_report(
    "pm25_by_wind_sector_srv14",
    lambda i: reports.pm25_by_wind_sector(i.aq_weather),
    """case when avg_wind_dir is null then 'Unknown' when avg_wind_dir < 90 then 'NE (0-90)' when avg_wind_dir < 180
       then 'SE (90-180)' when avg_wind_dir < 270 then 'SW (180-270)' else 'NW (270-360)' end as wind_sector, city""",
    ["avg_pm25"],
    "aq_weather",
)
_report("ratio_by_source_srv15", lambda i: reports.ratio_by_source(i.ratio), "city, source_indicator", ["pm25_pm10_ratio"], "ratio")
MONTH = "cast(date_trunc('month', measurement_date) as date) as month"
_report("raw_and_corrected_srv16", lambda i: reports.raw_and_corrected(i.aq_weather), MONTH, ["avg_pm25", "corrected_pm25"], "aq_weather")
_report("humidity_and_pm25_srv16", lambda i: reports.humidity_and_pm25(i.aq_weather), MONTH, ["avg_rh_2m", "avg_pm25"], "aq_weather")
_report("pressure_and_pm25_srv16", lambda i: reports.pressure_and_pm25(i.aq_weather), MONTH, ["avg_surface_pressure_hpa", "avg_pm25"], "aq_weather")
_report("calm_hours_srv16", lambda i: reports.calm_hours(i.aq_weather), f"{MONTH}, city", ["calm_wind_hours"], "aq_weather")
_report("exceedance_trend_srv17", lambda i: reports.exceedance_trend(i.exceedance), "year, city", ["who_exceedance_rate", "qcvn_exceedance_rate"], "exceedance")
_report("p95_by_month_srv17", lambda i: reports.p95_by_month(i.exceedance), "month_of_year, city", ["p95_pm25"], "exceedance")
register(
    "compliance_split_srv17_fn18",
    lambda i: reports.compliance_split(i.exceedance),
    """select year, cast(sum(total_days) - sum(who_exceedance_days) as bigint) as compliant_days,
              cast(sum(who_exceedance_days) - sum(qcvn_exceedance_days) as bigint) as who_only_days,
              cast(sum(qcvn_exceedance_days) as bigint) as qcvn_exceedance_days from exceedance group by 1""",
)
register(
    "year_month_heatmap_srv18",
    lambda i: _rounded(reports.year_month_heatmap(i.trend)),
    "select year, " + ", ".join(f"{settled_sql(f'avg(avg_pm25) filter (month_of_year = {m})', 6)} as m{m:02d}" for m in range(1, 13)) + " from trend group by 1",
)
_report("diurnal_by_city_srv16", lambda i: reports.diurnal_by_city(i.diurnal), "hour_of_day, city", ["avg_value"], "diurnal")
_report("forecast_by_date_srv19", lambda i: reports.forecast_by_date(i.accuracy), "forecast_date, model", ["forecast_pm25", "ci_lower_95", "ci_upper_95", "rolling_rmse_30d"], "accuracy")
_report("actual_and_forecast_srv19", lambda i: reports.actual_against_forecast(i.accuracy), "model", ["actual_pm25", "forecast_pm25", "holdout_rmse", "rolling_rmse_30d", "rolling_bias_30d"], "accuracy")
_report("rmse_by_station_srv19", lambda i: reports.rmse_by_station(i.accuracy), "location_name, model", ["holdout_rmse"], "accuracy")
register(
    "report_filters_srv20",
    lambda i: reports.choose(
        i.monthly, city=["ASIA", "EUROPE"], season=["NE Monsoon (Nov-Mar)"], location_name=None
    ).select("location_id", "parameter", "month_of_year", "city", "season", "avg_value"),
    """select location_id, parameter, month_of_year, city, season, avg_value from monthly
       where city in ('ASIA', 'EUROPE') and season = 'NE Monsoon (Nov-Mar)'""",
)

# Ad-hoc queries ----------------------------------------------------------------------

register(
    "raw_row_counts_ah01",
    lambda i: adhoc.row_counts({"batch": i.measurements_raw, "stream": i.live, "weather": i.weather_raw}),
    """select 'batch' as model, count(*) as rows from raw union all select 'stream', count(*) from live
       union all select 'weather', count(*) from weather_raw""",
)
register(
    "archive_extent_ah02",
    lambda i: adhoc.archive_extent(i.measurements_raw),
    "select min(year) as min_year, max(year) as max_year, count(distinct folder_station) as station_count from raw",
)
BY_PARAMETER_SQL = """select raw_parameter as parameter, count(*) as cnt,
                             case when bool_or(not_a_number) then 'NaN'::double else round(avg(value), 2) end as avg_value
                      from raw {where} group by 1"""
register(
    "readings_by_parameter_ah03",
    lambda i: adhoc.readings_by_parameter(i.measurements_raw),
    BY_PARAMETER_SQL.format(where=""),
)
register(
    "readings_by_parameter_month_ah03",
    lambda i: adhoc.readings_by_parameter(i.measurements_raw, 1997, 1),
    BY_PARAMETER_SQL.format(where="where year = '1997' and month = '01'"),
)
register(
    "weather_coverage_ah04",
    lambda i: adhoc.weather_coverage(i.weather_raw),
    """select location_id, count(*) as hourly_rows, strftime(min(date), '%Y-%m-%d') as earliest,
              strftime(max(date), '%Y-%m-%d') as latest from weather_raw group by 1 order by 1 limit 5""",
)
register(
    "stream_recency_ah05",
    lambda i: adhoc.stream_recency(i.live),
    """select count(*) as stream_rows, strftime(min(local_moment), '%Y-%m-%dT%H:%M:%S+07:00') as earliest,
              strftime(max(local_moment), '%Y-%m-%dT%H:%M:%S+07:00') as latest from live""",
)
register(
    "sentinel_rows_ah06",
    lambda i: adhoc.sentinel_rows(i.measurements_raw),
    "select count(*) as sentinel_rows from raw where value = -999",
)
register(
    "parameters_present_ah07",
    lambda i: adhoc.parameters_present(i.measurements_raw),
    "select distinct raw_parameter as parameter from raw",
)
register(
    "parameter_month_ah08",
    lambda i: adhoc.parameter_month(i.measurements_raw, "pm25", 1997, 3),
    """select count(*) as cnt, case when bool_or(not_a_number) then 'NaN'::double else avg(value) end as avg_value
       from raw where year = '1997' and month = '03' and raw_parameter = 'pm25'""",
)
register(
    "mart_row_counts_ah09",
    lambda i: adhoc.row_counts(
        {"mart_daily_air_quality": i.daily_aq, "mart_daily_aqi": i.daily_aqi, "mart_lagged_features": i.features}
    ),
    """select 'mart_daily_air_quality' as model, count(*) as rows from daily_aq
       union all select 'mart_daily_aqi', count(*) from daily_aqi
       union all select 'mart_lagged_features', count(*) from features""",
)
register(
    "city_plausibility_ah10",
    lambda i: adhoc.city_plausibility(i.daily_aqi, i.daily_aq),
    """select a.city, round(avg(p.avg_value), 1) as mean_pm25, round(avg(composite_aqi), 0) as mean_composite_aqi
       from daily_aqi a join pm25_days p using (location_id, measurement_date) group by 1""",
)
register(
    "city_hours_ah11",
    lambda i: adhoc.city_hours(i.diurnal, "ASIA"),
    """select day_type, hour_of_day, round(avg(avg_value), 1) as avg_pm25 from diurnal
       where parameter = 'pm25' and city = 'ASIA' group by 1, 2""",
)
register(
    "forecast_listing_ah12",
    lambda i: adhoc.forecast_listing(i.next_week.where("model = 'snaive7'")),
    """select location_name, forecast_date, round(forecast_pm25, 1) as pm25_fcst, round(ci_lower_95, 1) as ci_low,
              round(ci_upper_95, 1) as ci_high from next_week where model = 'snaive7'""",
)

# Calendar of the ingest --------------------------------------------------------------

register(
    "month_window_src11",
    lambda i: month_window(i.stg.agg(F.max("measurement_date").alias("as_of")), 3),
    """select cast(m as date) as month_start, cast(year(m) as int) as year, cast(month(m) as int) as month
       from (select unnest(generate_series(date_trunc('month', max(measurement_date)) - interval 2 month,
                                           date_trunc('month', max(measurement_date)), interval 1 month)) as m from stg)""",
)
