"""Operators on small given frames, sources and sinks on files."""

import datetime as dt
import gzip
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from airsift import schemas
from airsift.operators import daily, forecast, monitoring, quality, serving, staging
from airsift.plans import build, writers
from airsift.sources import files, payloads
from airsift.streaming import live

DAY = dt.date(2025, 1, 1)


def stations(spark, count=9):
    rows = [(n, f"T{n}", "Hanoi", "Hanoi", 21.0, 105.0, "reference", 0) for n in range(1, count + 1)]
    return spark.createDataFrame(rows, schemas.STATIONS)


def test_daily_index_golden_rows(spark):
    given = [(1, "pm25", 9.0), (2, "pm25", 12.0), (3, "pm25", 35.4), (4, "pm25", 55.4), (5, "pm10", 54.0), (6, "pm10", 100.0), (7, "o3", 80.0)]
    rows = spark.createDataFrame([(n, 1, p, v, DAY) for n, p, v in given], "location_id int, sensor_id int, parameter string, measurement_value double, measurement_date date")
    found = {r.location_id: (r.aqi_value, r.aqi_category) for r in daily.mart_daily_air_quality(rows, stations(spark)).collect()}
    assert found == {
        1: (50, "Good"), 2: (56, "Moderate"), 3: (100, "Moderate"), 4: (150, "Unhealthy for Sensitive Groups"),
        5: (50, "Good"), 6: (73, "Moderate"), 7: (None, None),
    }


def per_pollutant(spark):
    usg = "Unhealthy for Sensitive Groups"
    rows = [(1, "pm25", 35.4, 100, "Moderate", 1.6), (1, "pm10", 100.0, 100, "Moderate", None), (2, "pm25", 30.0, 80, "Moderate", 1.4), (2, "pm10", 200.0, 120, usg, None)]
    return spark.createDataFrame(
        [(DAY, n, f"S{n}", "Hanoi", "Hanoi", 21.0, 105.0, "reference", *rest, 0) for n, *rest in rows],
        "measurement_date date, location_id int, location_name string, city string, province string, station_lat double, "
        "station_lon double, sensor_type string, parameter string, avg_value double, aqi_value int, aqi_category string, "
        "cigarette_equivalent double, is_outlier_station int",
    )


def test_composite_prefers_pm25_on_ties(spark):
    found = {r.location_id: (r.composite_aqi, r.dominant_pollutant, r.health_category) for r in daily.mart_daily_aqi(per_pollutant(spark)).collect()}
    assert found == {1: (100, "pm25", "Moderate"), 2: (120, "pm10", "Unhealthy for Sensitive Groups")}


@pytest.mark.parametrize(
    ("active", "age", "missing", "alert"), [(21, 1, 0, False), (15, 1, 6, True), (10, 8, 11, False), (19, 1, 2, False), (0, 0, 21, True)]
)
def test_completeness(spark, active, age, missing, alert):
    as_of = dt.date(2026, 1, 20)
    rows = [(n, as_of - dt.timedelta(days=age)) for n in range(active)] + [(n, dt.date(2025, 12, 1)) for n in range(30 if active else 0)]
    frame = spark.createDataFrame(rows, "location_id int, measurement_date date")
    found = monitoring.completeness(frame, as_of, expected=21, alert_below=18).first()
    assert (found.active, found.missing, found.alert) == (active, missing, alert)


def test_alarm_streak_ends_at_a_missing_period(spark):
    rows = [("M", "", dt.datetime(2024, 1, d), v) for d, v in [(1, 9.0), (2, 9.0), (3, 1.0), (4, 9.0), (6, 9.0), (7, 9.0)]]
    metrics = spark.createDataFrame(rows, "metric string, dimension string, ts timestamp, value double")
    found = monitoring.evaluate_alarms(metrics, [monitoring.AlarmRule("M", 5, periods=2)]).orderBy("period_start").collect()
    assert [(r.period_start.day, r.streak, r.alarm) for r in found] == [(1, 1, False), (2, 2, True), (4, 1, False), (6, 1, False), (7, 2, True)]


def test_geojson_skips_unusable_rows(spark):
    schema = (
        "location_id string, location_name string, city string, station_lat string, station_lon string, sensor_type string, "
        "composite_aqi string, health_category string, dominant_pollutant string, pm25_avg string, cigarette_equivalent string, measurement_date string"
    )
    good = ("7441", "A", "Hanoi", "21.02", "105.8", "reference", "88", "Moderate", "pm25", "27.34", "1.24", "2026-03-26")
    bad = ("1", "B", "Hanoi", "n/a", "105.8", "reference", "88", "Moderate", "pm25", "27.34", "1.24", "2026-03-27")
    unreadable = [(*good[:6], "n/a", *good[7:]), (*good[:9], "oops", *good[10:]), (*good[:10], "?", good[11])]
    blank = ("7440", "Z", "Hanoi", "21.02", "105.8", "reference", "", "Moderate", "pm25", "", None, "2026-03-26")
    document = json.loads(serving.geojson(spark.createDataFrame([blank], schema)).first().geojson)
    assert document["features"][0]["properties"]["composite_aqi"] is None
    document = json.loads(serving.geojson(spark.createDataFrame([*unreadable, good, bad], schema)).first().geojson)
    assert document["type"] == "FeatureCollection" and document["updated_at"] == "2026-03-27"
    (feature,) = document["features"]
    assert feature["geometry"] == {"type": "Point", "coordinates": [105.8, 21.02]}
    assert feature["properties"]["colour"] == "#ffff00" and feature["properties"]["pm25_avg"] == 27.3


def test_empty_map_is_a_document(spark):
    frame = serving.latest_station_aqi(daily.mart_daily_aqi(per_pollutant(spark)), dt.date(2026, 1, 1))
    document = json.loads(serving.geojson(frame).first().geojson)
    assert document == {"type": "FeatureCollection", "updated_at": "", "features": []}


def test_hourly_payload_keeps_wanted_dates(spark):
    hourly = {name: [20.0, 21.0, 22.0] for name in payloads.HOURLY_FIELDS}
    hourly["time"] = ["2024-01-01T00:00", "2024-01-02T01:00", "2024-01-01T02:00"]
    answers = spark.createDataFrame([(1, json.dumps({"hourly": hourly}))], "location_id int, payload string")
    dates = spark.createDataFrame([(dt.date(2024, 1, 1),)], "date date")
    found = payloads.explode_hourly(answers, dates).orderBy("hour_utc").collect()
    assert [(r.hour_utc, r.temperature_2m) for r in found] == [(0, 20.0), (2, 22.0)]


def test_archive_files_quoted_and_not(spark, tmp_path):
    lines = {
        "locationid=7/year=2024/month=01": 'location_id,sensors_id,location,datetime,lat,lon,parameter,units,value\n7,1,"A, B",2024-01-01T00:30:00+07:00,21.1234567,105,PM25,ug,12.5\n7,1,x,,21,105,pm25,ug,3\n',
        "locationid=8/year=2025/month=02": 'location_id,sensors_id,location,datetime,lat,lon,parameter,units,value\n"8","2","C","2025-02-01T12:00:00Z","21","105","pm10","ug","700"\n"8","2","C","2025-02-01T13:00:00Z","21","105","pm25","ug","oops"\n',
    }
    for folder, text in lines.items():
        target = tmp_path / folder
        target.mkdir(parents=True)
        (target / "part.csv.gz").write_bytes(gzip.compress(text.encode()))
    staged = staging.stage_measurements(files.read_measurements(spark, str(tmp_path))).orderBy("location_id").collect()
    assert [(r.location_id, r.location, str(r.measured_at), str(r.measurement_date), r.lat, r.parameter, r.measurement_value) for r in staged] == [
        (7, "A, B", "2023-12-31 17:30:00", "2023-12-31", 21.123457, "pm25", 12.5),
        (8, "C", "2025-02-01 12:00:00", "2025-02-01", 21.0, "pm10", 700.0),
    ]
    assert files.backfill(spark, str(tmp_path), years=[2025]).select("location_id").distinct().collect()[0][0] == "8"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_weather_files_per_day(spark, tmp_path):
    rows = [(n, f"2024-01-0{d}", h, 20.0, 50.0, 1.0, 90.0, 0.0, 1010.0, 400.0) for n in (1, 2) for d in (1, 2) for h in range(3)]
    frame = spark.createDataFrame(rows, schemas.WEATHER_RAW)
    writers.write_weather_landing(frame, str(tmp_path / "w"))
    assert len(list((tmp_path / "w").glob("day=*"))) == 2
    back = files.read_weather(spark, str(tmp_path / "w"))
    assert sorted(back.drop("day").collect()) == sorted(frame.collect())
    one = back.where("day = '2024-01-02'")
    assert one.count() == 6 and len(one.inputFiles()) >= 1 and "PartitionFilters: [isnotnull(day" in plan(one)


def test_positional_landing_folders(spark, tmp_path):
    folder = tmp_path / "2024" / "01" / "31" / "07"
    folder.mkdir(parents=True)
    (folder / "a.gz").write_bytes(gzip.compress(b'{"location_id": 1, "value": 2.5}\n'))
    found = files.read_stream_landing(spark, str(tmp_path / "*/*/*/*")).first()
    assert (found.value, found.arrival_year, found.arrival_month, found.arrival_day, found.arrival_hour) == (2.5, 2024, 1, 31, 7)


def test_live_stream_from_json_files_replays_nothing_twice(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    args = [str(tmp_path / name) for name in ("valid", "errors", "checkpoint")]

    def drain():
        live.land_live(live.read_live(spark, str(source), 1), *args, once=True).awaitTermination()
        return files.read_stream_landing(spark, args[0]).count()

    def add(name, *values):
        lines = [json.dumps({"location_id": 1, "sensors_id": 1, "parameter": "pm25", "value": v}) for v in values]
        (source / name).write_text("\n".join(lines))

    add("a.json", 1.0, -999.0, 2.0)
    assert drain() == 2
    add("b.json", 3.0)
    assert drain() == 3
    assert drain() == 3
    hour = files.read_stream_landing(spark, args[0]).where("y = '2024' and h = '07'")
    assert "PartitionFilters: [isnotnull(y" in plan(hour)


def series_frame(spark, values, station=1):
    rows = [(station, f"S{station}", "Hanoi", dt.date(2024, 1, 1) + dt.timedelta(days=n), float(v)) for n, v in enumerate(values)]
    return spark.createDataFrame(rows, "location_id int, location_name string, city string, measurement_date date, avg_pm25 double")


def test_fitted_model_recovers_a_weekly_pattern():
    week = np.array([10, 12, 15, 11, 9, 20, 25.0])
    values = np.tile(week, 12)
    mean, lower, upper = forecast.LagDifference.fit(values).forecast(values, 7)
    assert np.allclose(mean, week, atol=1e-6) and np.allclose(lower, upper, atol=1e-5)
    assert forecast.walk_forward_rmse(values, forecast.LagDifference.fit, 30, 60) < 1e-6


def test_failing_walk_keeps_the_forecast():
    class Stubborn(forecast.LagDifference):
        def forecast(self, history, horizon):
            if horizon == 1:
                raise ValueError("one step only")
            return super().forecast(history, horizon)

    values = np.tile([10, 12, 15, 11, 9, 20, 25.0], 15)

    def fit(train):
        model = forecast.LagDifference.fit(train)
        return Stubborn(model.daily, model.weekly, model.sigma)

    expected = fit(values[:75]).forecast(values[:75], 30)[0]
    assert forecast.walk_forward_rmse(values, fit, 30, 60) == float(np.sqrt(np.mean((np.maximum(expected, 0) - values[75:]) ** 2)))
    assert forecast.walk_forward_rmse(values, lambda train: 1 / 0, 30, 60) == 0.0
    # The holdout is the caller's choice.
    assert forecast.walk_forward_rmse(np.append(values, 1000.0), forecast.LagDifference.fit, 45, 60) > 0


def test_failing_station_yields_an_error_row(spark):
    def fit(values):
        if values[0] > 50:
            raise ValueError("cannot fit")
        return forecast.LagDifference.fit(values)

    values = np.tile([10, 12, 15, 11, 9, 20, 25.0], 10)
    series = series_frame(spark, values).unionByName(series_frame(spark, values + 90, 2))
    fitted = forecast.fit_series(series, fit).cache()
    rows = forecast.model_forecasts(fitted, "2024-04-01", "m")
    assert [r.status for r in fitted.where("location_id = 2").collect()] == ["ValueError: cannot fit"]
    assert rows.count() == 7 and rows.select("location_id").distinct().first()[0] == 1
    summary = forecast.run_summary(series, fitted, rows).first()
    assert (summary.stations_ok, summary.errors, summary.records) == (1, 1, 7)


def test_short_series_has_no_backtest(spark):
    found = forecast.baseline_backtest(series_frame(spark, range(20))).collect()
    assert {(r.steps, r.holdout_rmse) for r in found} == {(0, 0.0)}


def test_checks_store_failing_rows(spark, tmp_path):
    by_pollutant = per_pollutant(spark).withColumns(
        {"max_value": F.col("avg_value"), "min_value": F.col("avg_value"), "reading_count": F.lit(1)}
    )
    composite = daily.mart_daily_aqi(by_pollutant).withColumn("composite_aqi", F.lit(700))
    tables = {"mart_daily_aqi": composite, "mart_daily_air_quality": by_pollutant, "stations": stations(spark, 1)}
    summary = {r.check_name: r.failing_rows for r in quality.run_checks(tables, DAY, str(tmp_path)).collect()}
    assert summary["accepted_composite_range"] == 2 and summary["composite_is_source_max"] == 2
    assert summary["station_known_mart_daily_aqi"] == 1 and summary["unique_mart_daily_aqi"] == 0
    assert spark.read.parquet(str(tmp_path / "accepted_composite_range")).count() == 2


def test_build_excludes_tags_and_rewrites_from_a_month_on(inputs, spark, tmp_path):
    recent = inputs.readings.where("datetime >= '2001-05-01'")
    sources = {"measurements_raw": recent, "weather_raw": inputs.weather_raw.where("date >= '2001-05-01'"), "stations": inputs.stations, "holidays": inputs.holidays}
    names = [model.name for model in build.selected_models(sources, [build.REPORT_ONLY])]
    assert "mart_feature_stats" not in names and "mart_forecast_accuracy" not in names and len(names) == 13
    target = str(tmp_path)
    full = build.build_all(spark, sources, target, [build.REPORT_ONLY])
    before = full["mart_daily_aqi"].where("measurement_date < '2001-09-01'").count()
    # From September on the archive has been corrected; earlier folders must stay as they are.
    later = {**sources, "measurements_raw": recent.where("datetime >= '2001-09-01' and sensors_id % 2 = 0")}
    again = build.build_all(spark, later, target, [build.REPORT_ONLY], since=dt.date(2001, 9, 15))
    assert again["mart_daily_aqi"].where("measurement_date < '2001-09-01'").count() == before > 0
    sensors = again["int_measurements_enriched"].where("measurement_date >= '2001-09-01'")
    assert sensors.where("sensor_id % 2 = 1").count() == 0 < sensors.count()
    # An archive that lost a month: nothing of it may stay, in no table.
    fewer = {**sources, "measurements_raw": recent.where("datetime < '2001-10-01' or datetime >= '2001-11-01'")}
    last = build.build_all(spark, fewer, target, [build.REPORT_ONLY], since=dt.date(2001, 9, 1))
    for name in ("stg_measurements", "mart_daily_air_quality", "mart_daily_aqi", "mart_lagged_features"):
        assert last[name].where("trunc(measurement_date, 'MM') = '2001-10-01'").isEmpty()
        assert not last[name].where("measurement_date < '2001-10-01'").isEmpty()


def test_increment_reads_only_recent_archive_folders(spark, tmp_path):
    for month in ("2023-12", "2024-01", "2024-02", "2024-03"):
        folder = tmp_path / f"locationid=7/year={month[:4]}/month={month[5:]}"
        folder.mkdir(parents=True)
        (folder / "a.csv").write_text(f"location_id,sensors_id,location,datetime,lat,lon,parameter,units,value\n7,1,A,{month}-05T12:00:00+07:00,21,105,pm25,ug,12.5\n")
    pruned = build.raw_since(files.read_measurements(spark, str(tmp_path)), dt.date(2024, 2, 1))
    assert sorted(row["month"] for row in pruned.select("month").distinct().collect()) == ["01", "02", "03"]
    assert "PartitionFilters: []" not in plan(pruned) and "PartitionFilters: [(concat_ws" in plan(pruned)
