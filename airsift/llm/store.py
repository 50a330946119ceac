"""Intermediate tables in the cluster's shared folder, and joins that broadcast only what was counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsift.plans.writers import write_sizing
from airsift.session import shared_folder

# A list of ids is sent to every executor only up to this size; beyond it the join shuffles. A row of the hashed list was
# measured at 40 bytes with one column; each further one takes 16.
BROADCAST_BYTES = 32 << 20
BROADCAST_ROW, BROADCAST_COLUMN = 40, 16
# Texts in a batch between the JVM and Python, and their bytes: a batch ends with the row that passes either.
BATCH_ROWS, BATCH_BYTES = 500, 16 << 20
# What a stored table was shuffled for is read once, by its own write; else the files stay until the driver collects garbage.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written as Parquet to the shared folder and read back: lineage ends there."""
    spark = frame.sparkSession
    path = shared_folder(spark, f"llm-{purpose}")
    with write_sizing(spark, DROP_SHUFFLES):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def drop_stored(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing reads any more: all frames over them are stored themselves."""
    for table in tables:
        spark = table.sparkSession
        jvm = spark._jvm
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_list(rows: int, columns: int = 1) -> bool:
    """Whether a list of numbers may be sent to every executor."""
    return rows * (BROADCAST_ROW + BROADCAST_COLUMN * (columns - 1)) <= BROADCAST_BYTES


def only_ids(frame: DataFrame, ids: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``frame`` whose ``on`` columns are (``left_semi``) or are not (``left_anti``) in the stored table ``ids``."""
    side = F.broadcast(ids) if small_list(ids.count(), len(on)) else ids
    renamed = side.select(*(F.col(name).alias(f"_{name}") for name in on))
    condition = F.lit(True)
    for name in on:
        condition = condition & frame[name].eqNullSafe(renamed[f"_{name}"])
    return frame.join(renamed, condition, how)


def small_batches(frame: DataFrame) -> DataFrame:
    """``frame``, in a session that hands texts to Python in small batches.

    Spark's default of 10,000 rows or 64 MB makes batches of texts which the JVM and the Python worker each hold several
    times. Both settings are lowered, never raised; one text longer than the bytes is a batch of its own.
    """
    conf = frame.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    bytes_key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = conf.get(bytes_key).lower().removesuffix("b")
    if not (held.isdigit() and 0 < int(held) <= BATCH_BYTES):
        conf.set(bytes_key, f"{BATCH_BYTES}b")
    return frame


def documents_of(frame: DataFrame) -> DataFrame:
    """Id and text alone, whatever other columns the table has."""
    return small_batches(frame).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
