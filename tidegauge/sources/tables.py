"""Parquet tables as batch and as stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table stored as ``<folder>/<name>.parquet`` (a file or a folder of files)."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def table_stream(
    spark: SparkSession, folder: str, name: str, files_per_batch: int = 1000
) -> DataFrame:
    """The same table as a stream, be it a file or a folder of files.

    ``files_per_batch`` bounds a micro-batch, and with it the rows of one key
    that a stateful task sees at once.
    """
    path = f"{folder.rstrip('/')}/{name}.parquet"
    stream = (
        spark.readStream.schema(table(spark, folder, name).schema)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getFileStatus(place).isDirectory():
        return stream.parquet(path)
    # A stream reads folders only; of this one it takes the one file.
    return stream.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
