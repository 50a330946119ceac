"""Live readings: micro-batch read, validation, enrichment, hourly landing files, metrics.

No step keeps state, so a restart replays from the checkpointed source offsets. A batch may therefore be written more
than once; when it arrived is decided once, before its first write, and kept in a ledger beside the checkpoint.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airsift import schemas
from airsift.operators import staging
from airsift.plans.writers import FOLDER_SIZING, arrival_folders, write_sizing, write_table

LANDING_FOLDERS = ["y", "m", "d", "h", "batch"]
ERROR_FOLDERS = ["y", "m", "d", "batch"]
LANDING_TRIGGER = "300 seconds"
# When this batch arrived, as a column of its readings.
LANDED_AT = "landed_at"
ARRIVAL = f"{LANDED_AT} timestamp, name string"
Clock = Callable[[], dt.datetime]


def read_live(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of JSON readings from a folder."""
    reader = spark.readStream.schema(schemas.STREAM_RAW)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def read_live_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Stream of JSON readings from a Kafka topic; needs Spark's Kafka package on the cluster."""
    records = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", "earliest").load()
    )
    parsed = F.from_json(F.col("value").cast("string"), schemas.STREAM_RAW)
    return records.select(parsed.alias("reading")).select("reading.*")


def enrich_live(readings: DataFrame, sensors: DataFrame) -> DataFrame:
    """Stream-static left join: fill parameter, units, place and position from the sensor lookup."""
    lookup = sensors.select(
        F.col("sensor_id").alias("sensors_id"),
        *[F.col(name).alias(f"known_{name}") for name in ("parameter", "units", "location_name", "lat", "lon")],
    )
    joined = readings.join(lookup, "sensors_id", "left")
    filled = {
        "parameter": F.coalesce("known_parameter", "parameter", F.lit("")),
        "units": F.coalesce("known_units", "units", F.lit("")),
        "location": F.coalesce("known_location_name", "location", F.lit("")),
        "lat": F.coalesce(F.nullif("lat", F.lit(0.0)), "known_lat"),
        "lon": F.coalesce(F.nullif("lon", F.lit(0.0)), "known_lon"),
    }
    return joined.withColumns(filled).drop(*[c for c in joined.columns if c.startswith("known_")])


def _write_json(rows: DataFrame, folders: list[str], path: str) -> None:
    """Gzip JSON lines per folder; a station's rows of an hour meet in one task, which AQE splits where too big."""
    placed = rows.hint("rebalance", *folders, "location_id").sortWithinPartitions(*folders, "location_id")
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*folders).option("compression", "gzip").json(path)


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def batch_arrival(spark: SparkSession, ledger: str, batch_id: int, clock: Clock = now) -> tuple[dt.datetime, str]:
    """When a batch arrived and the name of its folders: as the ledger has it, else from now on as decided here.

    The entry is complete before any reading is written, so an attempt that failed anywhere after it is repeated with
    the same hour and name. The name has a random part: batches of another checkpoint, which count from 0 again, never
    meet these folders.
    """
    path = f"{ledger.rstrip('/')}/batch={batch_id}"
    try:
        known = spark.read.schema(ARRIVAL).json(path).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        known = []
    if not known:
        entry = [(clock(), f"{batch_id}-{uuid.uuid4().hex[:12]}")]
        spark.createDataFrame(entry, ARRIVAL).coalesce(1).write.mode("overwrite").json(path)
        known = spark.read.schema(ARRIVAL).json(path).collect()
    return known[0][LANDED_AT], known[0]["name"]


def land_batch(
    target: str, errors: str, metrics: str | None, arrival: Column | None = None, ledger: str | None = None, clock: Clock = now
) -> Callable[[DataFrame, int], None]:
    """Write one micro-batch: valid rows by arrival hour, rejected rows apart, counts as metrics.

    Folders are hours, then batches: a reader of one hour lists that hour only. ``ledger`` (by default
    ``<target>/_arrivals``) belongs to one checkpoint and fixes each batch's arrival, so that replaying a batch, an hour
    later too, overwrites its own folders instead of adding rows twice. ``arrival`` may take the time from the readings
    and from ``landed_at``, the batch's arrival, but must not read the clock. The batch is evaluated once.
    """
    entries = ledger or f"{target.rstrip('/')}/_arrivals"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        landed_at, name = batch_arrival(spark, entries, batch_id, clock)
        marked = staging.split_live_readings(batch).withColumn(LANDED_AT, F.lit(landed_at)).persist()
        moment = F.col(LANDED_AT) if arrival is None else arrival
        folders = [*arrival_folders(moment), F.lit(name).alias("batch")]
        dropped = {"is_valid", LANDED_AT}
        rows = marked.select("*", *folders)
        valid = rows.where("is_valid").drop("reason", *dropped)
        rejected = rows.where(~F.col("is_valid")).drop("h", *dropped)
        try:
            with write_sizing(spark, FOLDER_SIZING):
                _write_json(valid, LANDING_FOLDERS, target)
                _write_json(rejected, ERROR_FOLDERS, errors)
            if metrics is not None:
                counts = staging.counts_of_rejected(marked).withColumn("ts", F.lit(landed_at))
                write_table(counts, f"{metrics}/batch={name}")
        finally:
            marked.unpersist()

    return write


def land_live(
    readings: DataFrame,
    target: str,
    errors: str,
    checkpoint: str,
    metrics: str | None = None,
    arrival: Column | None = None,
    once: bool = False,
    clock: Clock = now,
) -> StreamingQuery:
    """Start the landing query; ``once`` drains what is there and stops. The ledger lies in the checkpoint's folder."""
    trigger = {"availableNow": True} if once else {"processingTime": LANDING_TRIGGER}
    write = land_batch(target, errors, metrics, arrival, f"{checkpoint.rstrip('/')}/arrivals", clock)
    return readings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
