"""Table sinks. AQE sizes the output files, no sink funnels rows through one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORECAST_FOLDERS = ["generated_at", "model"]

# How AQE merges the shuffle partitions of a write. Many small folders: the cost is
# opening files, so keep the tasks parallel. No folders: aim at full-size files.
_COALESCE = "spark.sql.adaptive.coalescePartitions"
FOLDER_SIZING = {f"{_COALESCE}.parallelismFirst": "true", f"{_COALESCE}.minPartitionSize": "64KB"}
FILE_SIZING = {f"{_COALESCE}.parallelismFirst": "false"}
# A task writes up to so many folders side by side, without sorting its rows by folder; with more it sorts the rest.
OPEN_FOLDERS = {"spark.sql.maxConcurrentOutputFileWriters": "100"}


@contextmanager
def write_sizing(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the duration of one write."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), replace_touched_only: bool = False) -> None:
    """Write Snappy Parquet, partition columns last.

    The rebalance hint gathers the rows of a partition folder into few files, splits
    a folder that outgrows a task and merges small shuffle partitions.
    """
    columns = [name for name in df.columns if name not in partition_by] + list(partition_by)
    writer = df.select(*columns).hint("rebalance", *partition_by).write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        mode = "dynamic" if replace_touched_only else "static"
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", mode)
    with write_sizing(df.sparkSession, FOLDER_SIZING if partition_by else FILE_SIZING):
        writer.parquet(path)


MONTH = "stored_month"


def read_months(spark: SparkSession, like: DataFrame, path: str) -> DataFrame:
    """A table of month folders; the columns are known, so no job looks for them."""
    return spark.read.schema(with_month_last(like).schema).parquet(path)


def with_month_last(df: DataFrame, day: str | None = None) -> DataFrame:
    month = F.trunc(day, "MM") if day else F.lit(None).cast("date")
    return df.withColumn(MONTH, month)


def write_months(df: DataFrame, path: str, day: str, in_place: bool = False) -> None:
    """Write a table in a folder per month of its date column ``day``, sorted by station and day.

    Row-group statistics find a day within its month. ``in_place`` leaves rows to the tasks that read them, for
    raw-sized tables whose source already lies by time; else rows of a month are gathered, and months too big for a
    task are split.
    """
    order = [name for name in ("location_id", day) if name in df.columns]
    rows = with_month_last(df, day)
    placed = rows if in_place else rows.hint("rebalance", MONTH)
    writer = placed.sortWithinPartitions(MONTH, *order).write.mode("overwrite").option("compression", "snappy")
    with write_sizing(df.sparkSession, FOLDER_SIZING):
        writer.partitionBy(MONTH).option("partitionOverwriteMode", "static").parquet(path)


def write_forecasts(df: DataFrame, path: str) -> None:
    """Add or replace one forecast run; the folders of earlier runs stay."""
    write_table(df, path, FORECAST_FOLDERS, replace_touched_only=True)


def write_weather_landing(df: DataFrame, path: str) -> None:
    """JSON lines in a folder per day, a day's stations together; a range of days is a range of folders."""
    rows = df.withColumn("day", F.date_format(F.col("date").try_cast("date"), "yyyy-MM-dd"))
    writer = rows.hint("rebalance", "day").sortWithinPartitions("day", "location_id").write.mode("overwrite")
    with write_sizing(df.sparkSession, FOLDER_SIZING):
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("day").json(path)


def arrival_folders(moment: Column) -> list[Column]:
    """Folder columns of an arrival time, hour by hour."""
    return [
        F.date_format(moment, "yyyy").alias("y"),
        F.date_format(moment, "MM").alias("m"),
        F.date_format(moment, "dd").alias("d"),
        F.date_format(moment, "HH").alias("h"),
    ]
