"""Running a stream over what its source holds now."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.plans.shared import new_folder
from tidegauge.sinks.writers import to_files
from tidegauge.streaming.jobs import keyed_state


def drained(stream: DataFrame, mode: str = "append", kind: str = "parquet") -> DataFrame:
    """Run ``stream`` until its source is used up; the result as a table.

    Results are written as files to the shared folder, never gathered on the
    driver.  Windows that the watermark has not closed stay in the state.
    """
    spark = stream.sparkSession
    folder, checkpoint = new_folder(spark, "sink"), new_folder(spark, "progress")
    with keyed_state(spark):
        query = to_files(stream, folder, checkpoint, kind, mode=mode)
    query.awaitTermination()
    return spark.read.schema(stream.schema).format(kind).load(folder)


# Behind every time of a stream, and within the range that pandas has for times.
END_OF_TIME = datetime(2200, 1, 1)


def run_to_the_end(
    stream: DataFrame, time: str, start: Callable[[DataFrame], StreamingQuery]
) -> None:
    """Run a query over what ``stream`` holds now, then move its watermark past all rows.

    ``start`` starts the query, on one checkpoint, and is called twice: for the
    second run one more row is there, empty but for a time in ``END_OF_TIME``.
    That row waits for a watermark that never comes.
    """
    spark = stream.sparkSession
    folder = new_folder(spark, "end")
    spark.createDataFrame([], stream.schema).write.parquet(folder)
    whole = stream.unionByName(spark.readStream.schema(stream.schema).parquet(folder))
    with keyed_state(spark):
        query = start(whole)
    query.awaitTermination()
    last = F.lit(END_OF_TIME)
    empty = [
        (last if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in stream.schema.fields
    ]
    spark.range(1).select(*empty).write.mode("append").parquet(folder)
    with keyed_state(spark):
        query = start(whole)
    query.awaitTermination()


def drained_to_the_end(
    stream: DataFrame, time: str, rule: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The result of ``rule`` on all rows that ``stream`` holds now, as a table.

    Nothing stays behind the watermark: see ``run_to_the_end``.
    """
    spark = stream.sparkSession
    folder, checkpoint = new_folder(spark, "sink"), new_folder(spark, "progress")
    run_to_the_end(stream, time, lambda whole: to_files(rule(whole), folder, checkpoint))
    return spark.read.schema(rule(stream).schema).parquet(folder)
