"""Registered queries over stored tables: replayed batches, increments, state, pruned reads, compaction, ingest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsift import schemas
from airsift.operators import features, profiles, staging
from airsift.plans import audit as audit_plan
from airsift.plans import build, ingest, serve, versions
from airsift.plans.writers import OPEN_FOLDERS, write_sizing
from airsift.session import shared_folder
from airsift.sources import files, incremental
from airsift.streaming import live
from catalog.inputs import AS_OF, Inputs
from catalog.registry import register

# Replayed batches --------------------------------------------------------------------


def _clock(*times: str) -> Callable[[], dt.datetime]:
    """A clock that shows one time after the other."""
    shown = iter(times)
    return lambda: dt.datetime.fromisoformat(next(shown))


class _Lost(Exception):
    pass


def _replayed_batch(i: Inputs) -> DataFrame:
    """Two streams with checkpoints of their own land batch 0 in one target, one of them again in the next hour.

    The clock moves on between the attempts; the readings carry no time the folders could go by.
    """
    root = shared_folder(i.spark, "live")
    paths = [f"{root}/{name}" for name in ("valid", "errors", "metrics")]
    for half, times in ((0, ("2024-01-30T10:59:59+00:00", "2024-01-30T11:00:01+00:00")), (1, ("2024-01-30T10:30:00+00:00",))):
        batch = i.live.where(F.col("sensors_id") % 2 == half)
        for time in times:
            live.land_batch(*paths, ledger=f"{root}/checkpoint{half}/arrivals", clock=_clock(time))(batch, 0)
    landed = files.read_stream_landing(i.spark, paths[0]).groupBy("arrival_hour", "parameter").agg(F.count("*").alias("n_rows"))
    refused = i.spark.read.parquet(paths[2]).groupBy("parameter").agg(F.sum("rejected").alias("n_rows"))
    return landed.unionByName(refused.withColumn("arrival_hour", F.lit(None).cast("int")))


register(
    "live_replay_next_hour_snk04_str04_str06_str07",
    _replayed_batch,
    """select cast(10 as int) as arrival_hour, parameter, count(*) as n_rows from judged where reason = '' group by 2
       union all
       select null, case parameter when '' then 'unknown' else parameter end, count(*) from judged where reason <> '' group by 2""",
)

# Increments --------------------------------------------------------------------------

INCREMENT, BROKEN_FROM, OLD_MONTH = dt.date(2001, 9, 1), dt.date(2001, 7, 10), dt.date(1997, 3, 1)


def _sources(i: Inputs) -> dict[str, DataFrame]:
    return {"measurements_raw": i.readings, "weather_raw": i.weather_raw, "stations": i.stations, "holidays": i.holidays}


def _digest(tables: dict[str, DataFrame]) -> DataFrame:
    """Something of five tables that are built one after the other."""
    parts = [
        tables["stg_measurements"].groupBy("location_id").agg(F.count("*").alias("n_rows"), F.max("measurement_date").alias("newest")),
        tables["stg_weather"].groupBy("location_id").agg(F.count("*").alias("n_rows"), F.max("measurement_date").alias("newest")),
        tables["mart_daily_aqi"].groupBy("location_id").agg(F.count("*").alias("n_rows"), F.max("measurement_date").alias("newest")),
        tables["mart_lagged_features"].groupBy("location_id").agg(F.count("*").alias("n_rows"), F.max("measurement_date").alias("newest")),
        tables["mart_monthly_profile"].groupBy("location_id").agg(F.sum("reading_count").alias("n_rows"), F.lit(None).cast("date").alias("newest")),
    ]
    out = None
    for name, part in zip(("stg", "stg_weather", "aqi", "lagged", "monthly"), parts):
        named = part.select(F.lit(name).alias("source"), "*")
        out = named if out is None else out.unionByName(named)
    return out


DIGEST_SQL = """
    select 'stg' as source, location_id, count(*) as n_rows, max(measurement_date) as newest from stg group by 2
    union all select 'stg_weather', location_id, count(*), max(measurement_date) from stg_weather group by 2
    union all select 'aqi', location_id, count(*), max(measurement_date) from daily_aqi group by 2
    union all select 'lagged', location_id, count(*), max(measurement_date) from aq_weather where avg_pm25 is not null group by 2
    union all select 'monthly', location_id, cast(sum(reading_count) as bigint), null from monthly group by 2"""


def _failed_increment(i: Inputs) -> DataFrame:
    """A build, then an increment from a shrunken archive that fails after its first table: readers keep the build's tables."""
    target = shared_folder(i.spark, "build")
    sources = _sources(i)
    build.build_all(i.spark, sources, target, [build.REPORT_ONLY])
    broken = F.when(F.col("date") >= BROKEN_FROM.isoformat(), F.raise_error(F.lit("the weather archive is gone")).cast("string")).otherwise(F.col("date"))
    fewer = {**sources, "measurements_raw": i.readings.where("sensors_id % 2 = 0"), "weather_raw": i.weather_raw.withColumn("date", broken)}
    try:
        build.build_all(i.spark, fewer, target, [build.REPORT_ONLY], since=BROKEN_FROM)
    except Exception as failure:
        if "the weather archive is gone" not in str(failure):
            raise
        return _digest(versions.read_tables(i.spark, target))
    raise AssertionError("the increment was meant to fail")


register("failed_increment_snk06", _failed_increment, DIGEST_SQL)
register(
    "first_increment_snk06",
    # Nothing is stored yet, so the bound is of no effect: everything is built.
    lambda i: _digest(build.build_all(i.spark, _sources(i), shared_folder(i.spark, "build"), [build.REPORT_ONLY], since=INCREMENT)),
    DIGEST_SQL,
)

def _lagged_increment(i: Inputs) -> DataFrame:
    """Features of an archive that was wrong from one day on, then the increment from that day."""
    target = shared_folder(i.spark, "lagged")
    late = F.col("measurement_date") >= F.lit(INCREMENT)
    wrong = i.aq_weather.where(~late | (F.col("location_id") % 3 != 0)).withColumn("avg_pm25", F.when(late, F.col("avg_pm25") + 100).otherwise(F.col("avg_pm25")))
    before = versions.Draft(i.spark, target)
    stored = before.write("lagged", features.mart_lagged_features(wrong, i.holidays), "measurement_date")
    before.commit()
    later = versions.Draft(i.spark, target)
    later.write("lagged", features.lagged_features_since(i.aq_weather, stored, i.holidays, INCREMENT), "measurement_date", INCREMENT)
    later.commit()
    return versions.read_tables(i.spark, target)["lagged"]


register("lagged_increment_m09_win01_win02_win03", _lagged_increment, "select * from features")

# Checks by month ---------------------------------------------------------------------


def _repaired(i: Inputs) -> DataFrame:
    """Daily AQI with wrong labels in the last months and in one old month: checked, partly repaired, wholly repaired.

    The second run is handed the last months only. A row per run and check: failing rows by the summary and as stored.
    """
    audit = shared_folder(i.spark, "audit")
    late, old = F.col("measurement_date") >= F.lit(INCREMENT), F.trunc("measurement_date", "MM") == F.lit(OLD_MONTH)
    wrong = F.when(late | old, F.lit("dust")).otherwise(F.col("dominant_pollutant"))
    half = F.when(old, F.lit("dust")).otherwise(F.col("dominant_pollutant"))
    runs = [(wrong, None), (half, INCREMENT), (F.col("dominant_pollutant"), None)]
    table, out = "mart_daily_aqi", None
    for number, (label, since) in enumerate(runs, start=1):
        tables = {table: i.daily_aqi.withColumn("dominant_pollutant", label)}
        recent = {table: tables[table].where(late)} if since else None
        whole = {table: i.daily_aqi.limit(0)} if since else tables  # earlier months must not be needed
        summary = audit_plan.audited_checks(i.spark, whole, AS_OF, audit, days={table: "measurement_date"}, recent=recent, since=since)
        kept = audit_plan.failing_rows(i.spark, audit).get("accepted_dominant_pollutant")
        stored = kept.count() if kept is not None else 0
        row = summary.where("check_name = 'accepted_dominant_pollutant'").select(
            F.lit(number).alias("run"), "failing_rows", F.lit(stored).cast("bigint").alias("stored_rows")
        )
        # A summary is of its run's version, whose files the next run drops.
        row = i.spark.createDataFrame(row.collect(), row.schema)
        out = row if out is None else out.unionByName(row)
    return out


register(
    "checks_by_month_dq16_snk07",
    _repaired,
    f"""with wrong as (select count(*) filter (measurement_date >= date '{INCREMENT}') as late,
                          count(*) filter (date_trunc('month', measurement_date) = date '{OLD_MONTH}') as old from daily_aqi)
        select 1 as run, late + old as failing_rows, late + old as stored_rows from wrong
        union all select 2, old, old from wrong union all select 3, 0, 0""",
)

# Profiles from state -----------------------------------------------------------------


def _state(i: Inputs, name: str, derive: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """State of a corrupted archive, of which the last months are then replaced from readings of those months alone."""
    target = shared_folder(i.spark, "state")
    before = versions.Draft(i.spark, target)
    doubled = i.stg.where(F.col("measurement_date") >= F.lit(INCREMENT))
    before.write(name, derive(i.stg.unionByName(doubled)), profiles.STATE_MONTH)
    before.commit()
    later = versions.Draft(i.spark, target)
    later.write(name, derive(doubled), profiles.STATE_MONTH, INCREMENT)
    later.commit()
    return versions.read_tables(i.spark, target)[name]


register(
    "monthly_profile_from_state_m14_agg07",
    lambda i: profiles.monthly_profile_of(_state(i, "monthly", profiles.monthly_state), i.stations),
    "select * from monthly",
)
register(
    "diurnal_profile_from_state_m15_agg16",
    lambda i: profiles.diurnal_profile_of(_state(i, "diurnal", profiles.diurnal_state), i.stations),
    "select * from diurnal",
)

# Pruned reads ------------------------------------------------------------------------

SERVED_FIRST, SERVED_LAST = dt.date(1997, 2, 20), dt.date(1997, 4, 10)


def _stored_aqi(i: Inputs) -> str:
    target = shared_folder(i.spark, "serving")
    draft = versions.Draft(i.spark, target)
    draft.write("mart_daily_aqi", i.daily_aqi, "measurement_date")
    draft.commit()
    return target


def _months_opened(frame: DataFrame) -> Column:
    months = {file.partition(f"{versions.MONTH}=")[2].partition("/")[0] for file in frame.inputFiles()}
    return F.lit(",".join(sorted(months)))


def _days_served(i: Inputs) -> DataFrame:
    rows = serve.days_of(i.spark, _stored_aqi(i), "mart_daily_aqi", SERVED_FIRST, SERVED_LAST)
    counts = rows.groupBy("measurement_date").agg(F.count("*").alias("stations"), F.max("composite_aqi").alias("worst"))
    return counts.withColumn("months_opened", _months_opened(rows))


register(
    "stored_days_srv01_snk01",
    _days_served,
    f"""select measurement_date, count(*) as stations, max(composite_aqi) as worst, '1997-02-01,1997-03-01,1997-04-01' as months_opened
        from daily_aqi where measurement_date between date '{SERVED_FIRST}' and date '{SERVED_LAST}' group by 1""",
)
register(
    "stored_latest_aqi_srv01_jn08",
    lambda i: serve.latest_station_aqi(i.spark, _stored_aqi(i), AS_OF, 45).select("location_id", "composite_aqi", "measurement_date"),
    f"""select location_id, max_by(composite_aqi, measurement_date) as composite_aqi, strftime(max(measurement_date), '%Y-%m-%d') as measurement_date
        from daily_aqi where measurement_date >= date '{AS_OF}' - 45 group by 1""",
)


def _stored_completeness(i: Inputs) -> DataFrame:
    target = _stored_aqi(i)
    snapshot = versions.committed(i.spark, target)
    opened = snapshot.open(i.spark, "mart_daily_aqi", first=snapshot.newest_month("mart_daily_aqi"))
    found = serve.completeness(i.spark, target, AS_OF, expected=21, alert_below=18)
    return found.select("check_date", "active", "missing", "data_age_days").withColumn("months_opened", _months_opened(opened))


register(
    "stored_completeness_dq13",
    _stored_completeness,
    f"""select max(measurement_date) as check_date, active, 21 - active as missing, cast(date '{AS_OF}' - max(measurement_date) as int) as data_age_days,
               strftime(date_trunc('month', max(measurement_date)), '%Y-%m-%d') as months_opened
        from daily_aqi, (select cast(count(distinct location_id) as int) as active from daily_aqi
                         where measurement_date = (select max(measurement_date) from daily_aqi))
        group by active""",
)

# Compaction --------------------------------------------------------------------------


def _compacted(i: Inputs) -> DataFrame:
    """Readings written by eight tasks, each with a file a month, then packed: rows and files per month."""
    target = shared_folder(i.spark, "packed")
    draft = versions.Draft(i.spark, target)
    draft.write("stg_measurements", i.stg.repartition(8), "measurement_date", in_place=True)
    scattered = draft.commit()
    versions.compact(i.spark, target, "stg_measurements", too_many=2, order=("location_id", "measurement_date"))
    packed = versions.committed(i.spark, target)
    files_of = [(folder.partition("=")[2], scattered.entries[table, folder][1], value[1]) for (table, folder), value in packed.entries.items()]
    counted = i.spark.createDataFrame(files_of, "month string, files_before bigint, files_after bigint")
    rows = packed.open(i.spark, "stg_measurements").groupBy(F.trunc("measurement_date", "MM").cast("string").alias("month")).agg(F.count("*").alias("n_rows"))
    joined = rows.join(counted, "month")
    return joined.select("month", "n_rows", "files_after", (F.col("files_before") >= F.least(F.lit(2), "n_rows")).alias("were_more"))


register(
    "compacted_months_snk01_src01",
    _compacted,
    """select strftime(date_trunc('month', measurement_date), '%Y-%m-%d') as month, count(*) as n_rows, cast(1 as bigint) as files_after,
              true as were_more from stg group by 1""",
)

# Ingest of files ---------------------------------------------------------------------


def _half_year_archive(i: Inputs, rows: DataFrame, path: str) -> None:
    """Gzip text, one file per station and half-year; the month folder is its first month."""
    half = F.when(F.col("month") <= "06", F.lit("01")).otherwise(F.lit("07"))
    folders = ["locationid", "year", "month"]
    placed = rows.withColumn("month", half).repartition(*folders)
    options = {"header": True, "compression": "gzip", "quoteAll": True, "partitionOverwriteMode": "dynamic"}
    with write_sizing(i.spark, OPEN_FOLDERS):
        placed.write.mode("overwrite").partitionBy(*folders).options(**options).csv(path)


def _write_bytes(i: Inputs, path: str, content: bytes) -> None:
    hadoop = i.spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(i.spark._jsc.hadoopConfiguration()).create(hadoop, True)
    out.write(bytearray(content))
    out.close()


def _ingest_runs(i: Inputs) -> DataFrame:
    """Two runs over one archive. In between its first file gets its rows twice, and its last one is no gzip any more.

    A row per station: what the second run did, and the rows landed after it.
    """
    root = shared_folder(i.spark, "ingest")
    archive, target = f"{root}/archive", f"{root}/landed"
    _half_year_archive(i, i.measurements_raw, archive)
    ingest.ingest(i.spark, archive, target)
    listed = incremental.archive_listing(i.spark, archive)
    changed, broken = (listed.orderBy(*order).select("path").first()[0] for order in (["station_id", "month_start"], [F.desc("station_id"), F.desc("month_start")]))
    # A rewritten file keeps its name.
    once = i.spark.read.schema(schemas.MEASUREMENTS_RAW).option("header", True).csv(changed)
    once.union(once).coalesce(1).write.options(header=True, compression="gzip", quoteAll=True).csv(f"{root}/spare")
    content = i.spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(f"{root}/spare").select("content").first()[0]
    _write_bytes(i, changed, bytes(content))
    _write_bytes(i, broken, b"no gzip at all, only text")
    second = ingest.ingest(i.spark, archive, target)
    landed = ingest.read_landed(i.spark, target).groupBy(F.col("locationid").cast("int").alias("station_id")).agg(F.count("*").alias("landed_rows"))
    known = ingest.read_ledger(i.spark, target).groupBy(F.regexp_extract("path", r"/locationid=([^/]*)/", 1).cast("int").alias("station_id")).agg(F.count("*").alias("known_files"))
    told = second.select("station_id", "copied", "skipped", "failed", F.col("error").startswith("unreadable").alias("unreadable"))
    return told.join(landed, "station_id").join(known, "station_id")


register(
    "ingest_runs_src10",
    _ingest_runs,
    """with files as (select folder_station as station_id, year, month <= '06' as early, count(*) as n_rows from raw group by 1, 2, 3),
        marked as (select *, row_number() over (order by station_id, year, early desc) = 1 as changed,
                          row_number() over (order by station_id desc, year desc, early) = 1 as broken from files)
        select station_id, count(*) filter (changed) as copied, count(*) filter (not changed and not broken) as skipped,
               count(*) filter (broken) as failed, case when bool_or(broken) then true end as unreadable,
               cast(sum(case when changed then 2 * n_rows else n_rows end) as bigint) as landed_rows, count(*) as known_files
        from marked group by 1""",
)


def _allowlisted(i: Inputs) -> DataFrame:
    """Readings of listed stations from an archive in which a file of every other station cannot be read."""
    archive = f"{shared_folder(i.spark, 'archive')}/raw"
    _half_year_archive(i, i.measurements_raw, archive)
    unlisted = incremental.archive_listing(i.spark, archive).join(i.stations, F.col("station_id") == F.col("location_id"), "left_anti")
    for row in unlisted.groupBy("station_id").agg(F.min("path").alias("path")).collect():
        _write_bytes(i, row.path, b"no gzip at all, only text")
    rows = files.of_stations(files.read_measurements(i.spark, archive), i.stations)
    # Gzip text unpacks to many times the size that Spark goes by, which must not make it the side that is broadcast.
    return staging.enrich_measurements(staging.stage_measurements(rows), F.broadcast(i.stations)).groupBy("location_id", "location_name", "parameter").agg(F.count("*").alias("n_rows"))


register(
    "allowlisted_archive_jn01_prj10",
    _allowlisted,
    "select location_id, location_name, parameter, count(*) as n_rows from enriched group by 1, 2, 3",
)
