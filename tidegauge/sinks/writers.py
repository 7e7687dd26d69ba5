"""Writers for tables and streams.

A stream's checkpoint holds its progress and state; restarted on the same
checkpoint, a query goes on where it stopped.  Files are written once per
micro-batch; a topic may receive a record twice after a failure.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidegauge.functions.expressions import as_schema, micros
from tidegauge.schemas import CLEANED, REPORT
from tidegauge.sources.topics import DEFAULT_SERVERS


def json_messages(frame: DataFrame) -> DataFrame:
    """Each row as one JSON text in ``value``."""
    return frame.select(F.to_json(F.struct(*frame.columns)).alias("value"))


def report_messages(report: DataFrame) -> DataFrame:
    """Report rows, matched to the sink by position, as JSON."""
    return json_messages(as_schema(report, REPORT))


def cleaned_messages(cleaned: DataFrame) -> DataFrame:
    """Cleaned measurements (channel, time, value by position) as JSON.

    The record time travels inside the message: Spark's topic sink sets its own.
    """
    return json_messages(as_schema(cleaned, CLEANED))


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alerts as plain text."""
    return alerts.select(F.col("fraud_result").alias("value"))


def read_back(messages: DataFrame, schema, value: str = "value") -> DataFrame:
    """Columns out of JSON messages that were written here."""
    return messages.select(F.from_json(value, schema).alias("body")).select("body.*")


def topic_options(topic: str, servers: str = DEFAULT_SERVERS) -> dict[str, str]:
    """Options of the topic sink."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def stream_writer(
    frame: DataFrame,
    checkpoint: str,
    mode: str = "append",
    every: timedelta | None = None,
    name: str | None = None,
) -> DataStreamWriter:
    """A writer on its own checkpoint; without ``every`` it takes what is there and ends."""
    writer = frame.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{micros(every) // 1000} milliseconds")


def to_topic(
    messages: DataFrame, topic: str, checkpoint: str, servers: str = DEFAULT_SERVERS, **options
) -> StreamingQuery:
    """Start writing messages to a topic."""
    writer = stream_writer(messages, checkpoint, **options).format("kafka")
    return writer.options(**topic_options(topic, servers)).start()


def to_files(
    frame: DataFrame, folder: str, checkpoint: str, kind: str = "parquet", **options
) -> StreamingQuery:
    """Start writing to files: 'parquet' or 'json' for rows, 'text' for messages."""
    return stream_writer(frame, checkpoint, **options).format(kind).start(folder)


def to_table(frame: DataFrame, name: str, checkpoint: str, **options) -> StreamingQuery:
    """Start appending to a named table."""
    return stream_writer(frame, checkpoint, **options).toTable(name)


def to_console(frame: DataFrame, checkpoint: str, **options) -> StreamingQuery:
    """Start printing the results."""
    return stream_writer(frame, checkpoint, **options).format("console").start()


def insert_into(frame: DataFrame, name: str, kind: str = "parquet") -> None:
    """Append a table's rows to a named table, which is made if it is missing.

    Columns go to the table's columns by position and are cast to their types.
    """
    spark = frame.sparkSession
    if not spark.catalog.tableExists(name):
        frame.write.format(kind).saveAsTable(name)
        return
    as_schema(frame, spark.table(name).schema).write.insertInto(name)
