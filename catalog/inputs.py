"""The given tables seen as stations, readings, weather, live readings and payloads.

Values are whole numbers held as doubles, so sums do not depend on row order.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airsift.operators import city, daily, features, forecast, profiles, staging
from airsift.session import configure
from airsift.sources.files import typed_holidays

AS_OF = dt.date(2001, 11, 4)
LIVE_AS_OF = dt.date(2024, 1, 30)

HOLIDAYS = [
    ("1995-01-31", "New Year (lunar)", 1),
    ("1995-02-01", "New Year (lunar)", 1),
    ("1996-02-19", "New Year (lunar)", 1),
    ("1996-09-02", "National day", 0),
    ("1997-02-07", "New Year (lunar)", 1),
    ("1997-04-30", "Reunification day", 0),
    ("1998-01-28", "New Year (lunar)", 1),
    ("1998-05-01", "Labour day", 0),
    ("1999-02-16", "New Year (lunar)", 1),
    ("1999-09-02", "National day", 0),
    ("2000-02-05", "New Year (lunar)", 1),
    ("2001-05-01", "Labour day", 0),
]

STATIONS = [
    "n_nationkey as location_id",
    "n_name as location_name",
    "r_name as city",
    "r_name as province",
    "cast(20.0 + n_nationkey as double) as latitude",
    "cast(105.0 + n_nationkey as double) as longitude",
    "case when n_nationkey in (16, 19, 20) then 'low_cost' else 'reference' end as sensor_type",
    "case when n_nationkey = 20 then 1 else 0 end as is_outlier_station",
]

HOUR_OF_READING = "cast((l_orderkey * 7 + l_linenumber) % 24 as int)"
LOCAL_CLOCK = f"l_shipdate + make_interval(0, 0, 0, 0, {HOUR_OF_READING} + 7)"
# Archive cells are text; some rows are unreadable, missing or upper-case on purpose.
MEASUREMENTS_RAW = [
    "case when l_partkey % 229 <> 0 then cast(s_nationkey as string) end as location_id",
    "cast(l_suppkey as string) as sensors_id",
    "concat('place ', cast(s_nationkey as string)) as location",
    "case when l_partkey % 223 = 0 then null when l_partkey % 227 = 0 then 'not a date' "
    f"else concat(date_format({LOCAL_CLOCK}, \"yyyy-MM-dd'T'HH:mm:ss\"), '+07:00') end as datetime",
    "cast(cast(20 + s_nationkey as double) as string) as lat",
    "cast(cast(105 + s_nationkey as double) as string) as lon",
    "case l_returnflag when 'A' then if(l_partkey % 5 = 0, 'PM25', 'pm25') "
    "when 'N' then 'pm10' else 'relativehumidity' end as parameter",
    "'ug/m3' as units",
    "case when l_partkey % 211 = 0 then 'n/a' when l_partkey % 233 = 0 then 'NaN' "
    "when l_linenumber = 7 then '-999.0' "
    "when l_returnflag = 'A' and l_linenumber = 6 and l_quantity >= 49 then '985.0' "
    "else cast(l_quantity * case l_returnflag when 'A' then 7 when 'N' then 13 else 2 end as string) end as value",
    "cast(s_nationkey as string) as locationid",
    "date_format(l_shipdate, 'yyyy') as year",
    "date_format(l_shipdate, 'MM') as month",
]

# The same archive rows already typed, as the build stores them for the marts.
READINGS = [
    "case when l_partkey % 229 <> 0 then s_nationkey end as location_id",
    "cast(l_suppkey as int) as sensors_id",
    "concat('place ', cast(s_nationkey as string)) as location",
    "case when l_partkey % 223 <> 0 and l_partkey % 227 <> 0 "
    f"then cast(l_shipdate + make_interval(0, 0, 0, 0, {HOUR_OF_READING}) as timestamp) end as datetime",
    "cast(20 + s_nationkey as double) as lat",
    "cast(105 + s_nationkey as double) as lon",
    "case l_returnflag when 'A' then 'pm25' when 'N' then 'pm10' else 'relativehumidity' end as parameter",
    "'ug/m3' as units",
    "case when l_partkey % 211 = 0 then null when l_partkey % 233 = 0 then double('NaN') "
    "when l_linenumber = 7 then -999D when l_returnflag = 'A' and l_linenumber = 6 and l_quantity >= 49 then 985D "
    "else l_quantity * case l_returnflag when 'A' then 7D when 'N' then 13D else 2D end end as value",
]

WEATHER_RAW = [
    "c_nationkey as location_id",
    "date_format(o_orderdate, 'yyyy-MM-dd') as date",
    "cast(o_orderkey % 24 as int) as hour_utc",
    "if(o_orderkey % 101 = 0, null, cast(15 + o_custkey % 20 as double)) as temperature_2m",
    "cast(30 + o_custkey % 70 as double) as rh_2m",
    "cast(o_orderkey % 8 as double) as wind_speed",
    "cast((o_orderkey % 51) * 7 as double) as wind_dir",
    "cast(o_custkey % 9 as double) as precipitation_mm",
    "cast(1000 + o_custkey % 30 as double) as surface_pressure_hpa",
    "cast(100 + (o_orderkey * 7) % 1500 as double) as boundary_layer_height_m",
]

LIVE_PARAMETER = (
    "case event_type when 'click' then 'pm25' when 'view' then 'pm10' when 'purchase' then 'o3' "
    "when 'signup' then '' else 'radon' end"
)
LIVE_READINGS = [
    "user_id as location_id",
    "event_id as sensors_id",
    "concat('place ', cast(user_id as string)) as location",
    "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '+07:00') as datetime",
    "cast(null as double) as lat",
    "cast(null as double) as lon",
    f"{LIVE_PARAMETER} as parameter",
    "'ug/m3' as units",
    "case when event_id % 50 = 0 then cast(-999 as double) when event_id % 50 = 1 then -1 - value "
    "else value * 2 end as value",
    "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") as ingested_at",
]
# Declared, so that opening a table runs no job to look for its columns.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}
EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
TABLE_SCHEMAS["events"] = EVENTS_SCHEMA


class Inputs:
    """Lazy frames over one folder of the given tables, each derived at most once."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = configure(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def stations(self) -> DataFrame:
        joined = self.table("nation").join(self.table("region"), F.expr("n_regionkey = r_regionkey"))
        return joined.where("n_nationkey < 21").selectExpr(*STATIONS)

    @cached_property
    def _lines(self) -> DataFrame:
        return self.table("lineitem").join(self.table("supplier"), F.expr("l_suppkey = s_suppkey"))

    @cached_property
    def readings(self) -> DataFrame:
        return self._lines.selectExpr(*READINGS)

    @cached_property
    def measurements_raw(self) -> DataFrame:
        return self._lines.selectExpr(*MEASUREMENTS_RAW)

    @cached_property
    def stg_from_text(self) -> DataFrame:
        return staging.stage_measurements(self.measurements_raw)

    @cached_property
    def weather_source(self) -> DataFrame:
        return self.table("orders").join(self.table("customer"), F.expr("o_custkey = c_custkey"))

    @cached_property
    def weather_raw(self) -> DataFrame:
        return self.weather_source.selectExpr(*WEATHER_RAW)

    @cached_property
    def live(self) -> DataFrame:
        return self.table("events").selectExpr(*LIVE_READINGS)

    def live_stream(self) -> DataFrame:
        events = (
            self.spark.readStream.schema(EVENTS_SCHEMA)
            .option("pathGlobFilter", "events.parquet")
            .parquet(self.folder)
        )
        return events.selectExpr(*LIVE_READINGS)

    @cached_property
    def holidays_raw(self) -> DataFrame:
        rows = ", ".join(f"('{day}', '{name}', '{flag}')" for day, name, flag in HOLIDAYS)
        return self.spark.sql(f"select * from values {rows} as t(date, holiday_name, is_tet_period)")

    @cached_property
    def holidays(self) -> DataFrame:
        return typed_holidays(self.holidays_raw)

    @cached_property
    def stg(self) -> DataFrame:
        return staging.stage_measurements(self.readings)

    @cached_property
    def stg_weather(self) -> DataFrame:
        return staging.stage_weather(self.weather_raw)

    @cached_property
    def enriched(self) -> DataFrame:
        return staging.enrich_measurements(self.stg, self.stations)

    @cached_property
    def weather_enriched(self) -> DataFrame:
        return staging.enrich_weather(self.stg_weather, self.stations)

    @cached_property
    def daily_aq(self) -> DataFrame:
        return daily.mart_daily_air_quality(self.stg, self.stations)

    @cached_property
    def daily_aqi(self) -> DataFrame:
        return daily.mart_daily_aqi(self.daily_aq)

    @cached_property
    def daily_weather(self) -> DataFrame:
        return daily.mart_daily_weather(self.stg_weather, self.stations)

    @cached_property
    def aq_weather(self) -> DataFrame:
        return daily.mart_aq_weather_daily(self.daily_aq, self.daily_weather)

    @cached_property
    def ratio(self) -> DataFrame:
        return daily.mart_pollutant_ratio(self.daily_aq)

    @cached_property
    def features(self) -> DataFrame:
        return features.mart_lagged_features(self.aq_weather, self.holidays)

    @cached_property
    def feature_stats(self) -> DataFrame:
        return features.mart_feature_stats(self.features)

    @cached_property
    def health(self) -> DataFrame:
        return city.mart_health_summary(self.daily_aq)

    @cached_property
    def exceedance(self) -> DataFrame:
        return city.mart_exceedance_stats(self.daily_aq)

    @cached_property
    def trend(self) -> DataFrame:
        return city.mart_annual_monthly_trend(self.daily_aq)

    @cached_property
    def monthly(self) -> DataFrame:
        return profiles.mart_monthly_profile(self.stg, self.stations)

    @cached_property
    def diurnal(self) -> DataFrame:
        return profiles.mart_diurnal_profile(self.stg, self.stations)

    @cached_property
    def series(self) -> DataFrame:
        """Daily PM2.5 of trusted stations; the weather columns of the features are not needed."""
        rows = daily.trusted_pm25(self.daily_aq).select(
            "location_id", "location_name", "city", "measurement_date", F.col("avg_value").alias("avg_pm25")
        )
        return forecast.station_series(rows)

    @cached_property
    def next_week(self) -> DataFrame:
        return forecast.baseline_forecasts(self.series, AS_OF.isoformat())

    @cached_property
    def forecasts(self) -> DataFrame:
        """Forecast table: one-step history, an older run for even days, and the coming week."""
        known = forecast.baseline_one_step(self.series).where(F.col("predicted").isNotNull())
        even = F.day("measurement_date") % 2 == 0
        runs = F.explode(
            F.when(even, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        ).alias("older")
        scored = known.select("*", runs).select(
            *forecast.STATION,
            F.col("measurement_date").alias("forecast_date"),
            (F.col("predicted") + F.lit(5.0) * F.col("older")).alias("mean"),
            F.col("predicted").alias("lower"),
            (F.col("predicted") + F.lit(10.0)).alias("upper"),
            F.lit(12.5).alias("holdout_rmse"),
            F.expr("date_sub(previous_date, older)").alias("made_on"),
            "model",
        )
        history = forecast.as_forecast_rows(scored, F.date_format("made_on", "yyyy-MM-dd"))
        return history.unionByName(self.next_week)

    @cached_property
    def accuracy(self) -> DataFrame:
        return forecast.mart_forecast_accuracy(self.forecasts, self.daily_aq)
