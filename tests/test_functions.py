"""Published boundary values of the functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airsift.functions import aqi, calendar, rules, stats
from airsift.functions import weather as wx


def values(spark, schema, rows, column):
    return [row[0] for row in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


def test_pm25_index_boundaries(spark):
    given = [9.0, 12.0, 35.4, 55.4, 9.1, 35.5, 55.5, 125.5, 225.5, 500.0, 9.05, None]
    expected = [50, 56, 100, 150, 51, 101, 151, 201, 301, 500, 51, None]
    assert values(spark, "c double", [(v,) for v in given], aqi.aqi_pm25(F.col("c"))) == expected


def test_pm10_index_and_other_parameters(spark):
    rows = [("pm10", 54.0), ("pm10", 100.0), ("o3", 80.0)]
    index = aqi.aqi(F.col("p"), F.col("c"))
    category = aqi.aqi_category(F.col("p"), F.col("c"))
    assert values(spark, "p string, c double", rows, index) == [50, 73, None]
    assert values(spark, "p string, c double", rows, category) == ["Good", "Moderate", None]


def test_forecast_index_of_unusable_values_is_zero(spark):
    rows = [(-1.0,), (None,), (float("nan"),), (0.0,), (9.0,), (500.0,)]
    assert values(spark, "c double", rows, aqi.forecast_aqi(F.col("c"))) == [0, 0, 0, 0, 50, 500]


def test_category_from_index(spark):
    rows = [(50,), (51,), (150,), (200,), (300,), (301,), (None,)]
    assert values(spark, "i int", rows, aqi.category_from_aqi(F.col("i"))) == [
        "Good", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy", "Very Unhealthy", "Hazardous", None,
    ]


def test_humidity_correction(spark):
    rows = [("pm25", "low_cost", 50.0, 80.0), ("pm25", "low_cost", 50.0, None), ("pm25", "reference", 50.0, 80.0), ("pm10", "low_cost", 50.0, 80.0)]
    corrected = aqi.humidity_corrected(F.col("p"), F.col("s"), F.col("c"), F.col("h"))
    found = values(spark, "p string, s string, c double, h double", rows, corrected)
    assert found == [round(50 / 1.192, 4), round(50 / 1.168, 4), 50.0, None]


@pytest.mark.parametrize(
    ("fine", "coarse", "expected"),
    [(8.0, 10.0, "combustion-dominated"), (4.0, 10.0, "mixed"), (3.9, 10.0, "crustal/dust"), (1.0, 0.0, None), (None, 1.0, None)],
)
def test_particle_source(spark, fine, coarse, expected):
    source = aqi.particle_source(aqi.pm_ratio(F.col("f"), F.col("c")))
    assert values(spark, "f double, c double", [(fine, coarse)], source) == [expected]


def test_live_rejection_reasons(spark):
    rows = [(-999.0, "pm25"), (-5.0, "pm25"), (500.0, "pm25"), (20.0, "radon"), (20.0, ""), (20.0, "pm25"), (None, "pm25")]
    assert values(spark, "v double, p string", rows, rules.rejection_reason(F.col("v"), F.col("p"))) == [
        "sentinel_value", "negative_value", "value_out_of_range", "unknown_parameter", "", "", "value_out_of_range",
    ]


def test_archive_rule_keeps_high_pm10_and_drops_nan(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(v, p, day) for v, p in [(600.0, "pm10"), (600.0, "PM25"), (float("nan"), "pm10"), (-999.0, "o3"), (0.0, "o3"), (499.9, "pm25")]]
    rule = rules.archive_row_accepted(F.lit(1), F.col("t"), F.col("p"), F.col("v"))
    assert values(spark, "v double, p string, t timestamp", rows, rule) == [True, False, False, False, True, True]


def test_calendar(spark):
    days = [(dt.date(2024, 1, 6),), (dt.date(2024, 4, 8),), (dt.date(2024, 10, 6),)]
    assert values(spark, "d date", days, calendar.iso_weekday(F.col("d"))) == [6, 1, 7]
    assert values(spark, "d date", days, calendar.day_type(F.col("d"))) == ["Weekend", "Weekday", "Weekend"]
    assert values(spark, "d date", days, calendar.season(F.col("d"))) == ["NE Monsoon (Nov-Mar)", "Transition (Apr-May)", "Transition (Oct)"]


def test_circular_mean_crosses_north(spark):
    frame = spark.createDataFrame([(350.0,), (20.0,)], "a double")
    assert frame.agg(F.round(wx.circular_mean(F.col("a")), 6)).first()[0] == 5.0


def test_correlation_of_a_constant_is_null(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 9.0)], "x double, y double")
    assert frame.agg(stats.safe_corr(F.col("x"), F.col("y"))).first()[0] is None


def test_wind_sector(spark):
    rows = [(None,), (0.0,), (90.0,), (269.9,), (270.0,)]
    assert values(spark, "d double", rows, wx.wind_sector(F.col("d"))) == [
        "Unknown", "NE (0-90)", "SE (90-180)", "SW (180-270)", "NW (270-360)",
    ]
