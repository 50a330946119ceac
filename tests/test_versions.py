import datetime as dt

import pytest
from pyspark.sql import functions as F

from airsift.operators import profiles, staging
from airsift.plans import build, serve, versions
from airsift.sources import listing
from airsift.streaming import live

DAY = "measurement_date"


def days(spark, *values, station=1):
    rows = [(station, None if v is None else dt.date.fromisoformat(v), n) for n, v in enumerate(values)]
    return spark.createDataFrame(rows, f"location_id int, {DAY} date, n int")


def put(spark, target, frame, since=None, table="t"):
    draft = versions.Draft(spark, target)
    draft.write(table, frame, DAY, since)
    return draft.commit()


def read_days(spark, target, table="t"):
    return sorted(str(r[DAY]) for r in versions.read_tables(spark, target)[table].collect())


def test_nothing_is_visible_before_the_commit(spark, tmp_path):
    target = str(tmp_path)
    assert versions.read_tables(spark, target) == {} and versions.committed(spark, target).run == 0
    put(spark, target, days(spark, "2024-01-05", "2024-02-05"))
    draft = versions.Draft(spark, target)
    own = draft.write("t", days(spark, "2024-02-09"), DAY, dt.date(2024, 2, 1))
    assert sorted(str(r[DAY]) for r in own.collect()) == ["2024-01-05", "2024-02-09"]
    assert read_days(spark, target) == ["2024-01-05", "2024-02-05"]
    draft.commit()
    assert read_days(spark, target) == ["2024-01-05", "2024-02-09"]


def test_leftovers_of_a_failed_run_are_overwritten(spark, tmp_path):
    target = str(tmp_path)
    put(spark, target, days(spark, "2024-01-05"))
    versions.Draft(spark, target).write("t", days(spark, "2024-01-06", "2024-03-01"), DAY)  # never committed
    put(spark, target, days(spark, "2024-02-01"), dt.date(2024, 2, 1))
    assert read_days(spark, target) == ["2024-01-05", "2024-02-01"]


def test_emptied_months_go_and_undated_rows_stay(spark, tmp_path):
    target = str(tmp_path)
    put(spark, target, days(spark, None, "2024-01-05", "2024-02-05", "2024-03-05"))
    put(spark, target, days(spark, "2024-03-06"), dt.date(2024, 2, 1))
    assert read_days(spark, target) == ["2024-01-05", "2024-03-06", "None"]
    put(spark, target, days(spark), dt.date(2024, 1, 1))
    assert read_days(spark, target) == ["None"]
    put(spark, target, days(spark))
    assert versions.committed(spark, target).open(spark, "t", days(spark).schema).count() == 0


def test_of_two_writers_the_second_fails(spark, tmp_path):
    target = str(tmp_path)
    first, second = versions.Draft(spark, target), versions.Draft(spark, target)
    first.write("t", days(spark, "2024-01-05"), DAY)
    second.write("u", days(spark, "2024-01-05"), DAY)
    first.commit()
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        second.commit()


def test_a_bound_opens_only_the_months_that_can_hold_it(spark, tmp_path):
    target = str(tmp_path)
    put(spark, target, days(spark, None, "2023-12-31", "2024-01-05", "2024-02-05", "2024-03-05"))
    found = serve.days_of(spark, target, "t", dt.date(2024, 1, 20), dt.date(2024, 2, 28))
    assert [str(r[DAY]) for r in found.collect()] == ["2024-02-05"]
    assert {f.partition("stored_month=")[2][:7] for f in found.inputFiles()} == {"2024-01", "2024-02"}
    assert versions.committed(spark, target).newest_month("t") == dt.date(2024, 3, 1)
    assert serve.days_of(spark, target, "t", dt.date(2030, 1, 1)).count() == 0


def test_compaction_keeps_rows_and_leaves_tidy_months(spark, tmp_path):
    target = str(tmp_path)
    frame = days(spark, *[f"2024-01-{d:02d}" for d in range(1, 29)] * 4).repartition(6)
    draft = versions.Draft(spark, target)
    draft.write("t", frame, DAY, in_place=True)
    draft.commit()
    put(spark, target, days(spark, "2024-02-01"), dt.date(2024, 2, 1))
    before = versions.committed(spark, target)
    assert before.entries["t", "stored_month=2024-01-01"][1] == 6
    assert versions.compact(spark, target, "t") == ["stored_month=2024-01-01"]
    after = versions.committed(spark, target)
    assert after.entries["t", "stored_month=2024-01-01"][1] == 1
    assert after.entries["t", "stored_month=2024-02-01"] == before.entries["t", "stored_month=2024-02-01"]
    assert sorted(after.open(spark, "t").collect()) == sorted(before.open(spark, "t").collect())
    assert versions.compact(spark, target, "t") == []
    # Small bins: as many files as the listed bytes ask for, none of them much larger.
    size = before.entries["t", "stored_month=2024-01-01"][2] // 3
    other = str(tmp_path / "bins")
    draft = versions.Draft(spark, other)
    draft.write("t", frame, DAY, in_place=True)
    draft.commit()
    versions.compact(spark, other, "t", file_bytes=size, too_many=1)
    assert 2 <= versions.committed(spark, other).entries["t", "stored_month=2024-01-01"][1] <= 4


def test_unnamed_folders_are_dropped_and_named_ones_kept(spark, tmp_path):
    target = str(tmp_path)
    put(spark, target, days(spark, "2024-01-05", "2024-02-05"))
    for day in ("2024-02-06", "2024-02-07", "2024-02-08"):
        put(spark, target, days(spark, day), dt.date(2024, 2, 1))
    versions.Draft(spark, target).write("t", days(spark, "2030-01-01"), DAY)  # a run under way
    gone = [path.removeprefix(target) for path in versions.drop_unnamed(spark, target, keep=2)]
    assert sorted(gone) == ["/_snapshots/run=1", "/_snapshots/run=2", "/t/run=1/stored_month=2024-02-01", "/t/run=2"]
    assert read_days(spark, target) == ["2024-01-05", "2024-02-08"]
    assert (tmp_path / "t/run=3").exists() and (tmp_path / "t/run=5").exists()


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.gz").write_bytes(b"not gzip at all")
    (tmp_path / "a" / "_hidden").write_bytes(b"1")
    found = listing.list_files(spark, str(tmp_path)).collect()
    assert [(r.path.rpartition("/")[2], r.length) for r in found] == [("x.gz", 15)] and found[0].modified is not None
    assert listing.list_files(spark, str(tmp_path / "none")).count() == 0


def readings(spark, *values):
    rows = [(1, n, "A", None, None, None, "pm25", "ug", v, None) for n, v in enumerate(values)]
    return spark.createDataFrame(rows, "location_id bigint, sensors_id bigint, location string, datetime string, lat double, lon double, parameter string, units string, value double, ingested_at string")


def clock(*times):
    shown = iter(times)
    return lambda: dt.datetime.fromisoformat(next(shown)).replace(tzinfo=dt.timezone.utc)


def test_a_batch_that_failed_half_way_is_repeated_in_its_own_hour(spark, tmp_path, monkeypatch):
    paths = [str(tmp_path / name) for name in ("valid", "errors", "metrics")]
    batch = readings(spark, 1.0, 2.0, -999.0)
    write = live.land_batch(*paths, clock=clock("2024-01-31T23:59:59", "2024-02-01T00:00:01"))
    real, calls = live._write_json, []

    def failing(rows, folders, path):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("no space")
        real(rows, folders, path)

    monkeypatch.setattr(live, "_write_json", failing)
    with pytest.raises(OSError):
        write(batch, 7)
    write(batch, 7)
    folders = [str(p.relative_to(tmp_path)) for p in tmp_path.glob("valid/y=*/m=*/d=*/h=*/batch=*")]
    assert len(folders) == 1 and folders[0].startswith("valid/y=2024/m=01/d=31/h=23/batch=7-")
    assert spark.read.json(paths[0]).count() == 2 and spark.read.json(paths[1]).count() == 1
    assert [r.rejected for r in spark.read.parquet(paths[2]).collect()] == [1]


def test_a_batch_is_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for rows in batches:
            seen.add(rows.num_rows)
            yield rows

    batch = readings(spark, *map(float, range(50)), -1.0)
    live.land_batch(*(str(tmp_path / name) for name in ("v", "e", "m")))(batch.mapInArrow(counted, batch.schema), 0)
    assert seen.value == 51


def test_large_sketches_stay_within_their_rank_error(spark):
    """More readings than a sketch holds, in four months whose sketches are merged."""
    frame = spark.range(60_000).selectExpr(
        "1 as location_id", "'pm25' as parameter", "cast(id * 7919 % 60000 as double) as measurement_value",
        "add_months(date '2021-01-01', 12 * cast(id % 4 as int)) as measurement_date",
    )
    stations = spark.createDataFrame([(1, "S", "C", "P", 1.0, 2.0, "reference", 0)], "location_id int, location_name string, city string, province string, latitude double, longitude double, sensor_type string, is_outlier_station int")
    row = profiles.monthly_profile_of(profiles.monthly_state(frame), stations).first()
    assert (row.reading_count, row.min_value, row.max_value, row.day_count) == (60_000, 0.0, 59_999.0, 4)
    assert abs(row.p95_value - 57_000) <= 0.005 * 60_000


def test_profiles_read_the_recent_month_only(inputs, spark, tmp_path):
    """An increment derives state from staged readings of its months; the plan opens no other folder."""
    recent = inputs.readings.where("datetime >= '2001-06-01'")
    sources = {"measurements_raw": recent, "stations": inputs.stations}
    build.build_all(spark, sources, str(tmp_path))
    opened = []
    real = profiles.monthly_state

    def watched(rows):
        opened.append({f.partition("stored_month=")[2][:7] for f in rows.inputFiles()})
        return real(rows)

    names = {model.name: model for model in build.MODELS}
    model = names["mart_monthly_profile"]
    patched = [build._model(m.name, m.derive, m.needs, state=lambda t: watched(t["stg_measurements"])) if m is model else m for m in build.MODELS]
    whole = build.MODELS
    try:
        build.MODELS = patched
        tables = build.build_all(spark, sources, str(tmp_path), since=dt.date(2001, 10, 20))
    finally:
        build.MODELS = whole
    assert opened == [{"2001-10", "2001-11"}]
    expected = profiles.mart_monthly_profile(staging.stage_measurements(recent), inputs.stations)
    columns = [c for c in expected.columns]
    assert sorted(map(tuple, tables["mart_monthly_profile"].select(columns).collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
