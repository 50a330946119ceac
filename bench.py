"""Time the headline queries: prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

from airsift.plans.build import daily_run
from airsift.session import local_session, shared_folder
from airsift.sources.files import read_measurements
from catalog import all_queries
from catalog.inputs import AS_OF, Inputs

HEADLINE = [
    "stg_measurements_m01_prj01",
    "mart_daily_air_quality_m05",
    "mart_daily_aqi_m06",
    "mart_daily_weather_m07",
    "mart_aq_weather_daily_m08_jn05",
    "mart_lagged_features_m09",
    "mart_feature_stats_m10",
    "mart_health_summary_m11",
    "mart_exceedance_stats_m12",
    "mart_annual_monthly_trend_m13",
    "mart_monthly_profile_m14",
    "mart_diurnal_profile_m15",
    "mart_pollutant_ratio_m16",
    "mart_forecast_accuracy_m17",
    "fitted_forecast_fc03_m18",
    "latest_station_aqi_srv01_jn08",
    "alarms_dq15_win07",
]


def gzip_archive(spark, folder: str) -> str:
    """The readings as the archive holds them: gzip text, a file per station and month."""
    path = shared_folder(spark, "bench-archive")
    folders = ["locationid", "year", "month"]
    rows = Inputs(spark, folder).measurements_raw.repartition(64, *folders).sortWithinPartitions(*folders)
    rows.write.partitionBy(*folders).options(header=True, compression="gzip", quoteAll=True).csv(path)
    return path


def full_build(spark, folder: str, archive: str) -> None:
    """A whole day's run, from a gzip archive: all tables, forecasts, accuracy, every check."""
    inputs = Inputs(spark, folder)
    sources = {
        "measurements_raw": read_measurements(spark, archive),
        "weather_raw": inputs.weather_raw,
        "stations": inputs.stations,
        "holidays": inputs.holidays,
    }
    daily_run(spark, sources, shared_folder(spark, "bench"), AS_OF)[1].count()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    # Spark writes progress to standard output in places; the result must stay one line.
    with contextlib.redirect_stdout(sys.stderr):
        spark = local_session("bench", cores, int(cores) if cores.isdigit() else 8)
        queries = all_queries()
        # One small query first, so that the start of the JVM is not part of the figures.
        queries["mart_daily_aqi_m06"](spark, folder).limit(1).count()
        seconds = {}
        for name in HEADLINE:
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        archive = gzip_archive(spark, folder)
        start = time.perf_counter()
        full_build(spark, folder, archive)
        seconds["full_build_and_checks"] = round(time.perf_counter() - start, 3)
        spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
