import datetime as dt
import gzip
import json
import pathlib
import subprocess
import sys

import pytest

from airsift.operators import features
from airsift.plans import ingest
from airsift.sources import files, incremental

HEADER = "location_id,sensors_id,location,datetime,lat,lon,parameter,units,value\n"


def put(archive, station, year, month, values, name="a.csv.gz"):
    folder = archive / f"locationid={station}/year={year}/month={month}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = "".join(f"{station},7,A,{year}-{month}-05T12:00:00+07:00,21,105,pm25,ug,{value}\n" for value in values)
    (folder / name).write_bytes(gzip.compress((HEADER + lines).encode()))
    return folder / name


def landed(spark, target):
    return sorted((r.locationid, r.month, r.value) for r in ingest.read_landed(spark, target).collect())


def told(summary):
    return {r.station_id: (r.copied, r.skipped, r.failed) for r in summary.collect()}


def test_runs_take_each_file_once(spark, tmp_path):
    archive, target = tmp_path / "archive", str(tmp_path / "out")
    put(archive, 1, 2024, "01", [1.0, 2.0])
    changed = put(archive, 1, 2024, "02", [3.0])
    put(archive, 2, 2024, "01", [4.0])
    assert told(ingest.ingest(spark, str(archive), target)) == {1: (2, 0, 0), 2: (1, 0, 0)}
    assert told(ingest.ingest(spark, str(archive), target)) == {1: (0, 2, 0), 2: (0, 1, 0)}
    put(archive, 1, 2024, "02", [5.0, 6.0])
    broken = put(archive, 2, 2024, "03", [9.0] * 50)
    whole = broken.read_bytes()
    broken.write_bytes(whole[: len(whole) - 12])
    summary = ingest.ingest(spark, str(archive), target)
    assert told(summary) == {1: (1, 1, 0), 2: (0, 1, 1)}
    assert landed(spark, target) == [("1", "01", "1.0"), ("1", "01", "2.0"), ("1", "02", "5.0"), ("1", "02", "6.0"), ("2", "01", "4.0")]
    # A file that could not be read is new to the next run.
    broken.write_bytes(whole)
    assert told(ingest.ingest(spark, str(archive), target))[2] == (1, 1, 0)
    assert len(landed(spark, target)) == 55
    # A changed file without rows leaves none behind.
    changed.write_bytes(gzip.compress(HEADER.encode()))
    ingest.ingest(spark, str(archive), target)
    assert not [row for row in landed(spark, target) if row[:2] == ("1", "02")]


def test_a_run_that_fails_before_the_ledger_is_repeated(spark, tmp_path, monkeypatch):
    archive, target = tmp_path / "archive", str(tmp_path / "out")
    put(archive, 1, 2024, "01", [1.0, 2.0])
    real = ingest.Draft.commit
    monkeypatch.setattr(ingest.Draft, "commit", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest.ingest(spark, str(archive), target)
    monkeypatch.setattr(ingest.Draft, "commit", real)
    assert ingest.read_ledger(spark, target).count() == 0
    assert told(ingest.ingest(spark, str(archive), target)) == {1: (1, 0, 0)}
    assert len(landed(spark, target)) == 2 and ingest.read_ledger(spark, target).count() == 1


def test_window_and_listing(spark, tmp_path):
    archive = tmp_path / "archive"
    for month in ("01", "02", "03"):
        put(archive, 4, 2024, month, [1.0])
    listing = incremental.archive_listing(spark, str(archive)).collect()
    assert {(r.station_id, str(r.month_start)) for r in listing} == {(4, f"2024-{m}-01") for m in ("01", "02", "03")}
    assert told(ingest.ingest(spark, str(archive), str(tmp_path / "out"), (dt.date(2024, 3, 9), 2))) == {4: (2, 0, 0)}


def stations(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "location_id int")


def test_unlisted_stations_are_not_opened(spark, tmp_path, monkeypatch):
    put(tmp_path, 1, 2024, "01", [1.0])
    put(tmp_path, 2, 2024, "01", [1.0]).write_bytes(b"no gzip")
    rows = files.of_stations(files.read_measurements(spark, str(tmp_path)), stations(spark, 1, 3, None))
    assert [r.location_id for r in rows.collect()] == ["1"]
    assert "PartitionFilters: [locationid" in rows._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(files, "LISTED_STATIONS", 1)
    put(tmp_path, 2, 2024, "01", [2.0])
    joined = files.of_stations(files.read_measurements(spark, str(tmp_path)), stations(spark, 2, 3, 2))
    assert [r.value for r in joined.collect()] == ["2.0"]


@pytest.mark.parametrize("seam", ["2024-03-01", "2024-06-01", "2024-09-01", "2025-06-01"])
def test_increment_of_features_equals_full_build_over_gaps(spark, seam):
    """Stations with gaps of months over the seam, one that begins after it, one that ends before it."""
    first, rows = dt.date.fromisoformat(seam), []
    spans = {1: (0, 300, 1), 2: (0, 300, 9), 3: (200, 260, 1), 4: (0, 40, 1), 5: (0, 20, 1), 6: (170, 175, 1)}
    for station, (start, end, step) in spans.items():
        for n in range(start, end, step):
            if station == 5 or not 100 <= n < 150 or station == 2:
                rows.append((station, dt.date(2024, 1, 1) + dt.timedelta(days=n), float(n * 7 % 50) if n % 11 else None))
    rows += [(5, dt.date(2024, 12, 1), 4.0)]
    text, number, flag = ("location_name", "city", "province", "sensor_type"), ("corrected_pm25", "avg_rh_2m", "avg_wind_speed", "total_precipitation_mm"), ("inversion_risk", "wet_scavenging")
    frame = spark.createDataFrame(rows, "location_id int, measurement_date date, avg_pm25 double")
    frame = frame.selectExpr("*", *[f"'x' as {c}" for c in text], *[f"1D as {c}" for c in number], *[f"0 as {c}" for c in flag])
    holidays = spark.createDataFrame([(dt.date(2024, 3, 5), 1)], "holiday_date date, is_tet_period int")
    full = features.mart_lagged_features(frame, holidays)
    wrong = frame.where(f"measurement_date < '{seam}' or location_id % 2 = 0").selectExpr("* except (avg_pm25)", f"if(measurement_date < '{seam}', avg_pm25, 1D) as avg_pm25")
    stored = features.mart_lagged_features(wrong, holidays).select(*full.columns)
    changed = features.lagged_features_since(frame, stored, holidays, first).select(*full.columns).collect()
    months = {r.measurement_date.replace(day=1) for r in changed} | {first.replace(day=1)}
    kept = [r for r in stored.collect() if r.measurement_date < first and r.measurement_date.replace(day=1) not in months]
    assert sorted(map(str, kept + changed)) == sorted(map(str, full.collect()))


PLANS = """
import json, os, pathlib, sys
from airsift.session import local_session
from airsift.plans import ingest
from catalog import stored

root = pathlib.Path(sys.argv[1])
log = {"enabled": "true", "dir": f"file://{root}/events", "rolling.enabled": "false", "compress": "false"}
os.environ["PYSPARK_SUBMIT_ARGS"] = " ".join(f"--conf spark.eventLog.{key}={value}" for key, value in log.items()) + " pyspark-shell"
(root / "events").mkdir()
spark = local_session("plans", cores="2", shuffle_partitions=4)

class Given:
    pass

given = Given()
given.spark = spark
columns = "'7' as sensors_id, 'A' as location, '2024-01-05T12:00:00+07:00' as datetime, '21' as lat, '105' as lon, 'pm25' as parameter, 'ug' as units"
rows = spark.range(20000).selectExpr("string(id % 5) as location_id", *columns.split(", "), "string(id) as value", "string(id % 5) as locationid", "string(2020 + id % 3) as year", "lpad(string(1 + id % 12), 2, '0') as month")
stored._half_year_archive(given, rows, f"{root}/archive")
told = ingest.ingest(spark, f"{root}/archive", f"{root}/landed").agg({"copied": "sum"}).first()[0]
landed = ingest.read_landed(spark, f"{root}/landed").count()
spark.stop()

def nodes(plan):
    return [plan["nodeName"]] + [name for child in plan["children"] for name in nodes(child)]

found = []
for line in open(next((root / "events").iterdir())):
    plan = json.loads(line).get("sparkPlanInfo")
    names = nodes(plan) if plan else []
    if "WriteFiles" in names and any(name.startswith("Scan csv") or name in ("Range", "Exchange") for name in names):
        found.append(names)
print(json.dumps([told, landed, len(list((root / "archive").rglob("*.gz"))), found]))
"""


def test_folders_are_written_without_sorting_the_rows(tmp_path):
    """A sort by folder holds a task's rows in memory, which grow with the archive."""
    root = pathlib.Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", PLANS, str(tmp_path)], cwd=root, capture_output=True, text=True, timeout=300)
    told, landed, written, plans = json.loads(done.stdout.strip().splitlines()[-1])
    assert told == written == 30 and landed == 20000
    big = [names for names in plans if "Range" in names or any(name.startswith("Scan csv") for name in names)]
    assert len(big) >= 2 and not [names for names in big if "Sort" in names]
