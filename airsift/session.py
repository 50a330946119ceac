"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Dates and hours are derived from instants, so the session must read them in UTC.
# The rest are Spark defaults, pinned because the plans count on them: AQE merges
# small shuffle partitions, splits skewed ones and turns joins into broadcast joins
# when the measured side is below autoBroadcastJoinThreshold.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app_name: str = "airsift", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and laptops; on a cluster use its own session and ``configure``."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Only on one machine (a ``local`` master) a temporary folder stands in where it is not set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local") or spark.conf.get("spark.master").startswith("local-"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = os.path.join(tempfile.gettempdir(), "airsift")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
