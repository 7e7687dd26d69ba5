"""Files with one JSON message per line, in the form a topic has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _as_messages(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


def message_files(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of message files; the file's modification time is the transport time."""
    return _as_messages(spark.read.text(folder))


def message_file_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """The same folder as a stream, oldest files first."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return _as_messages(lines)
