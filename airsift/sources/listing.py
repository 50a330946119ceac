"""Files of a folder as rows, from their metadata alone: no content is read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTING = "path string, length bigint, modified timestamp"


def list_files(spark: SparkSession, path: str, name_pattern: str = "*") -> DataFrame:
    """``path``, ``length`` and ``modified`` of every file below ``path`` whose name fits ``name_pattern``.

    A path that does not exist has no files. Hidden files and folders are left out, as Spark's readers do.
    """
    try:
        found = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", name_pattern).load(path)
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))
