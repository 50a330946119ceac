"""Checks with stored state: counts per check and month, and the rows that fail now.

The audit folder is a set of versioned tables (see ``versions``): ``_counts``, ``_summary``, and one table per check that
has failing rows. A run over the months from a day on counts those months only and takes the others from ``_counts``;
rows that no longer fail leave with the same commit, and their files after it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airsift.operators import quality
from airsift.operators.quality import RowCheck, TableCheck, Tables
from airsift.plans.versions import Draft, drop_unnamed, read_tables

COUNTS, SUMMARY = "_counts", "_summary"
COUNT = "check_name string, month date, failing_rows bigint"


def _month(day: str | None):
    return (F.trunc(day, "MM") if day else F.lit(None).cast("date")).alias("month")


def _row_counts(rows: DataFrame, checks: Sequence[RowCheck], day: str | None) -> DataFrame:
    """(check_name, month, failing_rows) of a table's row checks, from one scan."""
    counts = rows.groupBy(_month(day)).agg(*[F.count_if(check.failing).alias(check.name) for check in checks])
    pairs = F.explode(F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.col(c.name).alias("failing_rows")) for c in checks]))
    return counts.select("month", pairs.alias("pair")).select("pair.check_name", "month", "pair.failing_rows")


def _query_counts(failing: DataFrame, check: TableCheck, day: str | None) -> DataFrame:
    return failing.groupBy(_month(day)).agg(F.count(F.lit(1)).alias("failing_rows")).select(F.lit(check.name).alias("check_name"), "month", "failing_rows")


def audited_checks(
    spark: SparkSession,
    tables: Tables,
    as_of: dt.date,
    audit_path: str,
    models: Sequence[str] = (),
    days: Mapping[str, str] | None = None,
    recent: Tables | None = None,
    since: dt.date | None = None,
) -> DataFrame:
    """Failing rows of every check whose tables are present, as a summary; the rows themselves are stored per check.

    ``days`` names the day column of tables whose months are independent of each other. With ``since``, a first of a
    month, and ``recent``, those tables from then on, their checks read ``recent`` only, provided an earlier run has
    counted the months before. All other checks read whole tables.
    """
    days, recent = dict(days or {}), dict(recent or {})
    draft = Draft(spark, audit_path)
    counted_before = since is not None and COUNTS in draft.before.tables()
    rows = [check for check in quality.row_checks(models) if check.table in tables]
    queries = [check for check in quality.table_checks(as_of) if set(check.tables) <= set(tables)]

    def bounded(*names: str) -> bool:
        return counted_before and all(name in days and name in recent for name in names)

    def rows_of(name: str) -> DataFrame:
        return recent[name] if bounded(name) else tables[name]

    def query_day(check: TableCheck) -> str | None:
        return check.day if all(name in days for name in check.tables) else None

    def query_bounded(check: TableCheck) -> bool:
        return query_day(check) is not None and bounded(*check.tables)

    def failing_of(check: TableCheck) -> DataFrame:
        return check.failing({**tables, **recent} if query_bounded(check) else tables)

    parts = []
    for name in sorted({check.table for check in rows}):
        parts.append(_row_counts(rows_of(name), [check for check in rows if check.table == name], days.get(name)))
    parts += [_query_counts(failing_of(check), check, query_day(check)) for check in queries]
    kept = [check.name for check in rows if bounded(check.table)] + [check.name for check in queries if query_bounded(check)]
    fresh = reduce(DataFrame.unionByName, parts).where("failing_rows > 0")
    if kept:
        old = draft.before.open(spark, COUNTS).where(F.col("check_name").isin(kept) & (F.col("month").isNull() | (F.col("month") < F.lit(since))))
        fresh = fresh.unionByName(old)
    counts = draft.write(COUNTS, fresh)
    names = spark.createDataFrame([(check.name,) for check in [*rows, *queries]], "check_name string")
    totals = counts.groupBy("check_name").agg(F.sum("failing_rows").alias("failing_rows"))
    summary = draft.write(SUMMARY, names.join(totals, "check_name", "left").select("check_name", F.coalesce("failing_rows", F.lit(0)).alias("failing_rows")))

    found = counts.where(F.col("month").isNull() | (F.col("month") >= F.lit(since))) if kept else counts
    failing_now = {row.check_name for row in found.select("check_name").distinct().collect()}  # at most one a check
    for check in [*rows, *queries]:
        if isinstance(check, RowCheck):
            day, bound = days.get(check.table), since if bounded(check.table) else None
            failing = rows_of(check.table).where(check.failing) if check.name in failing_now else None
        else:
            day, bound = query_day(check), since if query_bounded(check) else None
            failing = failing_of(check) if check.name in failing_now else None
        if failing is None:
            draft.drop(check.name, bound)
        else:
            draft.write(check.name, failing, day, bound)
    draft.commit()
    drop_unnamed(spark, audit_path, keep=1)
    return summary


def failing_rows(spark: SparkSession, audit_path: str) -> Tables:
    """The failing rows of each check that has some, as of the last run."""
    return {name: rows for name, rows in read_tables(spark, audit_path).items() if name not in (COUNTS, SUMMARY)}
