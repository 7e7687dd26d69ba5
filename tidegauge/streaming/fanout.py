"""Several sinks on one reading of a stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegauge.sinks.writers import stream_writer
from tidegauge.streaming.waiting import results


def fan_out(
    stream: DataFrame,
    sinks: Mapping[str, Callable[[DataFrame], DataFrame]],
    folder: str,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Start one query that reads every micro-batch once and writes what each sink makes of it.

    ``sinks`` maps names to functions of a micro-batch's rows.  The rows are kept while the
    sinks are written, on the executors; what is lost with one of them is read again.  Every
    sink writes a folder per micro-batch, so a micro-batch that is repeated after a failure
    overwrites its own files in all sinks, whichever of them it had reached.  A sink's rows
    are those of committed micro-batches: ``sink_rows`` reads them.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for name, made in sinks.items():
                made(batch).write.mode("overwrite").parquet(f"{folder}/{name}/rows/{number}")
        finally:
            batch.unpersist()

    return stream_writer(stream, checkpoint, **options).foreachBatch(write).start()


def sink_rows(
    spark: SparkSession, folder: str, name: str, checkpoint: str, schema: T.StructType
) -> DataFrame:
    """What one sink of a fan-out has been given so far."""
    return results(spark, f"{folder}/{name}", checkpoint, schema)
