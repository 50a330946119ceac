"""Versions of a set of tables: a run writes folders of its own, and one pointer file makes all of them visible at once.

    <target>/<table>/run=<n>/[stored_month=<day>/]part-…      what run n wrote of a table
    <target>/_snapshots/run=<n>/part-….json                   which run holds each folder of each table after run n

Readers resolve the newest pointer to explicit folders, so they see either all of a run or nothing of it, and a bound
on the day opens the months that can hold it only. A run that fails leaves folders no pointer names; the next run takes
its number and overwrites them. There is one writer at a time: of two, the second to commit fails.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from airsift.plans.writers import MONTH, with_month_last, write_months, write_table
from airsift.sources.listing import list_files

POINTERS = "_snapshots"
ENTRY = "table string, folder string, run bigint, files bigint, bytes bigint"
UNDATED = f"{MONTH}=__HIVE_DEFAULT_PARTITION__"
# Size of a file after compaction, and how many times the files needed a month may have before it is compacted.
FILE_BYTES, FILES_TOO_MANY = 128 << 20, 4

Entries = dict[tuple[str, str], tuple[int, int, int]]


def month_folder(day: dt.date) -> str:
    return f"{MONTH}={day.replace(day=1).isoformat()}"


@dataclass(frozen=True)
class Snapshot:
    """A pointer's content: (table, folder) to (run, files, bytes); folder is empty for tables without months."""

    target: str
    run: int = 0
    entries: Entries = field(default_factory=dict)

    def tables(self) -> set[str]:
        return {table for table, _ in self.entries}

    def folders(self, table: str, first: dt.date | None = None, last: dt.date | None = None) -> list[str]:
        """Folders of a table that can hold days from ``first`` to ``last``. Rows without a day have a folder too."""
        found = []
        for (name, folder), (run, _, _) in sorted(self.entries.items()):
            bounded = folder and (first is not None or last is not None)
            outside = bounded and (
                folder == UNDATED or first is not None and folder < month_folder(first) or last is not None and folder > month_folder(last)
            )
            if name == table and not outside:
                found.append(f"{self.target}/{table}/run={run}" + (f"/{folder}" if folder else ""))
        return found

    def open(self, spark: SparkSession, table: str, schema: StructType | None = None, day: str | None = None, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """A table as of this snapshot, without its folder columns.

        With ``day`` and a bound, the rows of those days; only the months that can hold them are listed and opened.
        Without ``schema`` it is read from the files.
        """
        folders = self.folders(table, first, last)
        if not folders:
            if schema is None:
                if table not in self.tables():
                    raise ValueError(f"no table {table} under {self.target}")
                return self.open(spark, table).limit(0)
            return spark.createDataFrame([], schema)
        reader = spark.read.option("basePath", f"{self.target}/{table}")
        if schema is not None:
            dated = (table, "") not in self.entries
            reader = reader.schema(with_month_last(spark.createDataFrame([], schema)).schema if dated else schema)
        rows = reader.parquet(*folders).drop("run", MONTH)
        if first is not None and day:
            rows = rows.where(F.col(day) >= F.lit(first))
        if last is not None and day:
            rows = rows.where(F.col(day) <= F.lit(last))
        return rows

    def newest_month(self, table: str) -> dt.date | None:
        months = [folder for name, folder in self.entries if name == table and folder and folder != UNDATED]
        return dt.date.fromisoformat(max(months).removeprefix(f"{MONTH}=")) if months else None


def _pointer(target: str, run: int) -> str:
    return f"{target}/{POINTERS}/run={run}"


def committed(spark: SparkSession, target: str) -> Snapshot:
    """The newest snapshot under ``target``; an empty one where nothing was committed yet."""
    target = target.rstrip("/")
    run = F.regexp_extract("path", r"/run=(\d+)/[^/]*$", 1).cast("long")
    newest = list_files(spark, f"{target}/{POINTERS}", "*.json").agg(F.max(run)).first()[0]
    if newest is None:
        return Snapshot(target)
    rows = spark.read.schema(ENTRY).json(_pointer(target, newest)).collect()  # a row per table and month
    return Snapshot(target, newest, {(r.table, r.folder): (r.run, r.files, r.bytes) for r in rows if r.table})


def read_tables(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """All tables of the newest snapshot: those of one run, however far the next one has come."""
    snapshot = committed(spark, target)
    return {table: snapshot.open(spark, table) for table in sorted(snapshot.tables())}


class Draft:
    """A run's tables as far as it has come: its own folders over those of the snapshot before. ``commit`` shows them."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark = spark
        before = committed(spark, target)
        self.before = before
        self.now = Snapshot(before.target, before.run + 1, dict(before.entries))

    def _path(self, table: str) -> str:
        return f"{self.now.target}/{table}/run={self.now.run}"

    def _written(self, table: str) -> Entries:
        """Folders this run wrote of a table, with their files and bytes, by listing."""
        folder = F.regexp_extract("path", r"/run=\d+/(.*/)?[^/]*$", 1)
        found = list_files(self.spark, self._path(table), "*.parquet").groupBy(F.rtrim(folder, F.lit("/")).alias("folder"))
        rows = found.agg(F.count("*").alias("files"), F.sum("length").alias("bytes")).collect()  # a row a month
        return {(table, r.folder): (self.now.run, r.files, r.bytes) for r in rows}

    def write(self, table: str, df: DataFrame, day: str | None = None, since: dt.date | None = None, in_place: bool = False) -> DataFrame:
        """Write ``df`` as the table, or with ``since`` (a first of a month) as its months from then on; return the table.

        Months from ``since`` on that ``df`` has no rows of are gone from this run on. What was written is read off the
        files, so ``df`` is derived once.
        """
        if day is None:
            write_table(df, self._path(table))
        else:
            write_months(df, self._path(table), day, in_place=in_place)
        written = self._written(table)
        kept = {key: value for key, value in self._beside(table, since if day else None).items() if key not in written}
        if not written and not any(name == table for name, _ in kept):
            write_table(df.limit(0).coalesce(1), self._path(table))  # an empty table still has its columns
            written = self._written(table)
        self.now.entries.clear()
        self.now.entries.update(kept | written)
        return self.open(table, df.schema)

    def _beside(self, table: str, since: dt.date | None) -> Entries:
        """Entries that stay when the table is replaced, or with ``since`` its months from then on."""

        def stays(name: str, folder: str) -> bool:
            return name != table or since is not None and folder != "" and (folder == UNDATED or folder < month_folder(since))

        return {key: value for key, value in self.now.entries.items() if stays(*key)}

    def drop(self, table: str, since: dt.date | None = None) -> None:
        """The table, or with ``since`` its months from then on, is gone from this run on; nothing is written."""
        kept = self._beside(table, since)
        self.now.entries.clear()
        self.now.entries.update(kept)

    def open(self, table: str, schema: StructType, day: str | None = None, first: dt.date | None = None) -> DataFrame:
        return self.now.open(self.spark, table, schema, day, first)

    def commit(self) -> Snapshot:
        """One pointer file for all tables of the run. Fails if another run took the number meanwhile."""
        rows = [(table, folder, *value) for (table, folder), value in sorted(self.now.entries.items())]
        rows = rows or [("", "", self.now.run, 0, 0)]  # a run without tables has a pointer too
        self.spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("errorifexists").json(_pointer(self.now.target, self.now.run))
        return self.now



def crowded_months(snapshot: Snapshot, table: str, file_bytes: int = FILE_BYTES, too_many: int = FILES_TOO_MANY) -> list[str]:
    """Month folders that have ``too_many`` times the files their bytes need, and more than one."""
    found = []
    for (name, folder), (_, files, size) in sorted(snapshot.entries.items()):
        if name == table and folder and files > 1 and files >= too_many * -(-size // file_bytes):
            found.append(folder)
    return found


def compact(spark: SparkSession, target: str, table: str, file_bytes: int = FILE_BYTES, too_many: int = FILES_TOO_MANY, order: tuple[str, ...] = ()) -> list[str]:
    """Pack the files of crowded months into files of about ``file_bytes``, as a run of its own; the months packed.

    Files are put into bins by their listed sizes, one after the other by path; a bin is a shuffle key and becomes a
    file, so rows of one month meet in as many tasks as the month has bins. Rows stay the same, and readers see the
    months either before or after. The other months stay where they are.
    """
    draft = Draft(spark, target)
    before = draft.before
    months = crowded_months(before, table, file_bytes, too_many)
    if not months:
        return []
    folders = [f"{before.target}/{table}/run={before.entries[table, month][0]}/{month}" for month in months]
    listed = None
    for folder in folders:  # a listing each; months are few
        found = list_files(spark, folder, "*.parquet")
        listed = found if listed is None else listed.union(found)
    month = F.regexp_extract("path", rf"/({MONTH}=[^/]*)/", 1)
    before_it = F.sum("length").over(Window.partitionBy("_month").orderBy("path").rowsBetween(Window.unboundedPreceding, -1))
    bins = listed.withColumn("_month", month).select("path", F.floor(F.coalesce(before_it, F.lit(0)) / file_bytes).alias("_bin"))
    rows = spark.read.option("basePath", f"{before.target}/{table}").parquet(*folders).drop("run")
    named = rows.withColumn("_file", F.col("_metadata.file_path")).join(bins, F.col("_file") == F.col("path")).drop("_file", "path")
    needed = sum(-(-before.entries[table, name][2] // file_bytes) for name in months)
    packed = named.repartition(max(1, needed), MONTH, "_bin").sortWithinPartitions(MONTH, *order).drop("_bin")
    packed.write.mode("overwrite").option("compression", "snappy").partitionBy(MONTH).parquet(draft._path(table))
    draft.now.entries.update(draft._written(table))
    draft.commit()
    return months


def drop_unnamed(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Delete folders of earlier runs that none of the newest ``keep`` snapshots names, and older pointers; their paths."""
    newest = committed(spark, target)
    kept = [newest]
    for run in range(newest.run - 1, max(0, newest.run - keep), -1):
        rows = spark.read.schema(ENTRY).json(_pointer(newest.target, run)).collect()
        kept.append(Snapshot(newest.target, run, {(r.table, r.folder): (r.run, r.files, r.bytes) for r in rows if r.table}))
    named = {folder for snapshot in kept for table in snapshot.tables() for folder in snapshot.folders(table)}
    oldest = kept[-1].run
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(newest.target).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []

    def below(folder: str) -> list[str]:
        return [f"{folder}/{entry.getPath().getName()}" for entry in files.listStatus(path(folder)) if entry.isDirectory()] if files.exists(path(folder)) else []

    for table in sorted({table for snapshot in kept for table in snapshot.tables()}):
        for run in below(f"{newest.target}/{table}"):
            number = run.rpartition("run=")[2]
            if not number.isdigit() or int(number) > newest.run or run in named:
                continue
            months = below(run)
            unnamed = [month for month in months if month not in named]
            gone += [run] if len(unnamed) == len(months) else unnamed
    gone += [pointer for pointer in below(f"{newest.target}/{POINTERS}") if int(pointer.rpartition("run=")[2]) < oldest]
    for folder in gone:
        files.delete(path(folder), True)
    return gone
