"""Archive files to raw rows, each file once: listing, ledger, readability, landing, ledger.

The ledger (path, etag) is a versioned table, replaced as a whole after the rows are written. A run that fails before
that is repeated: its files are still new, and their rows replace those of the failed attempt, since every file has a
folder of its own.
"""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airsift.plans.versions import Draft, committed
from airsift.plans.writers import FOLDER_SIZING, OPEN_FOLDERS, write_sizing, write_table
from airsift import schemas
from airsift.sources import files, incremental

LEDGER = "ledger"
FOLDERS = ["locationid", "year", "month", "source"]


def read_ledger(spark: SparkSession, target: str) -> DataFrame:
    snapshot = committed(spark, f"{target.rstrip('/')}/_ledger")
    if LEDGER not in snapshot.tables():
        return spark.createDataFrame([], "path string, etag string")
    return snapshot.open(spark, LEDGER)


def _readable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, content) to (path, error): whether a gzip file can be unpacked to its end, in pieces of a megabyte."""
    for batch in batches:
        errors = []
        for content in batch.column(batch.schema.get_field_index("content")):
            error, rest = None, content.as_py()
            try:
                while rest:
                    unpack = zlib.decompressobj(wbits=31)
                    piece = unpack.decompress(rest, 1 << 20)
                    while unpack.unconsumed_tail:
                        piece = unpack.decompress(unpack.unconsumed_tail, 1 << 20)
                    if not unpack.eof:
                        raise zlib.error("the file ends early")
                    rest = unpack.unused_data
            except zlib.error as failure:
                error = f"unreadable: {failure}"
            errors.append(error)
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("path")), pa.array(errors, pa.string())], names=["path", "error"])


def unreadable_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path`` and ``error`` of the given gzip files, error null where a file can be unpacked."""
    found = spark.read.format("binaryFile").load(paths).select("path", "content")
    return found.mapInArrow(_readable, "path string, error string")


def read_landed(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all files ingested so far, as archive text cells with the folder columns."""
    schema = f"{schemas.MEASUREMENTS_RAW}, {schemas.MEASUREMENTS_PARTITIONS}, source string"
    return spark.read.schema(schema).parquet(f"{target.rstrip('/')}/rows")


def _drop_emptied(spark: SparkSession, root: str, rows: DataFrame, sound: list[str], ledger: DataFrame) -> None:
    """Rows landed earlier of changed files that have no rows any more: no write replaces their folders."""
    taken = spark.createDataFrame([(path,) for path in sound], "path string")
    changed = [row.path for row in taken.join(ledger.select("path"), "path", "left_semi").collect()]
    if not changed:
        return
    full = {row[0] for row in rows.select(F.col("_metadata.file_path").alias("path")).where(F.col("path").isin(changed)).distinct().collect()}
    path = spark._jvm.org.apache.hadoop.fs.Path
    for emptied in set(changed) - full:
        folder, _, name = emptied.partition("/locationid=")[2].rpartition("/")
        where = path(f"{root}/rows/locationid={folder}/source={name}")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def ingest(spark: SparkSession, archive: str, target: str, window: tuple[dt.date, int] | None = None) -> DataFrame:
    """Take over the archive's new and changed files; a row per station with its copied, skipped and failed files.

    Files that cannot be unpacked are told with their error, keep their earlier rows, and are tried again by the next
    run. A changed file's rows replace its earlier ones. ``window`` (a day, n) looks at the last n months up to it only.
    """
    root = target.rstrip("/")
    ledgers = Draft(spark, f"{root}/_ledger")
    run = f"{root}/_runs/run={ledgers.now.run}"
    listing = incremental.archive_listing(spark, archive)
    if window is not None:
        listing = incremental.in_month_window(listing, *window)
    write_table(listing, f"{run}/listing")  # what the run goes by, also if files arrive meanwhile
    listing, ledger = spark.read.parquet(f"{run}/listing"), read_ledger(spark, root)
    # A reader takes paths from the driver, as it holds every file of what it scans anyway.
    paths = [row.path for row in incremental.new_or_changed(listing, ledger).select("path").collect()]
    outcomes = unreadable_files(spark, paths) if paths else spark.createDataFrame([], "path string, error string")
    write_table(outcomes, f"{run}/outcomes")
    outcomes = spark.read.parquet(f"{run}/outcomes")
    failed = {row.path for row in outcomes.where("error is not null").select("path").collect()}
    sound = [path for path in paths if path not in failed]
    if sound:
        schema = f"{schemas.MEASUREMENTS_RAW}, {schemas.MEASUREMENTS_PARTITIONS}"
        rows = spark.read.schema(schema).option("header", True).option("basePath", archive).csv(sound)
        named = rows.withColumn("source", F.col("_metadata.file_name"))
        with write_sizing(spark, FOLDER_SIZING | OPEN_FOLDERS):
            writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*FOLDERS).option("compression", "snappy").parquet(f"{root}/rows")
        _drop_emptied(spark, root, rows, sound, ledger)
    done = listing.join(outcomes.where("error is not null").select("path"), "path", "left_anti")
    ledgers.write(LEDGER, incremental.updated_ledger(done, ledger))
    ledgers.commit()
    return incremental.ingest_summary(listing, ledger, outcomes=outcomes)
