"""Measurements out of JSON messages, tolerant of bad ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.expressions import instant
from tidegauge.schemas import MEASUREMENT, MEASUREMENT_JSON, SENSOR_JSON


def decoded_measurements(
    raw: DataFrame, value: str = "value", transport: str = "timestamp"
) -> DataFrame:
    """Decode (value, transport time) messages to measurements.

    A missing field, or one of the wrong type, is NULL; numbers are accepted as
    channel ids.  Measurements without an event time are skipped, as no window
    could take them; so are lines that are not JSON, whose fields are all NULL.
    """
    decoded = raw.select(
        F.from_json(F.col(value).cast("string"), MEASUREMENT_JSON).alias("body"),
        F.col(transport).cast("timestamp").alias("ts"),
    )
    measured = decoded.select("body.*", "ts").withColumn("event_time", instant("timestamp"))
    return measured.where(F.col("event_time").isNotNull()).select(*MEASUREMENT.fieldNames())


def decoded_sensor_records(
    raw: DataFrame, value: str = "value", transport: str = "timestamp"
) -> DataFrame:
    """Decode (value, transport time) messages to sensor records, on tables and streams.

    Gives ``timestamp`` and ``value`` of the body, the event time and the transport's own
    time ``ts``.  A missing field, or one of the wrong type, is NULL; lines that are not JSON
    and records without a timestamp are skipped.
    """
    body = F.from_json(F.col(value).cast("string"), SENSOR_JSON)
    decoded = raw.select(body.alias("body"), F.col(transport).cast("timestamp").alias("ts"))
    records = decoded.select("body.*", instant("body.timestamp").alias("event_time"), "ts")
    return records.where(F.col("event_time").isNotNull())


def encoded_measurements(frame: DataFrame, channel: str, value: str, time: str) -> DataFrame:
    """The reverse: measurement columns to (value text, transport time) messages."""
    at = F.col(time).cast("timestamp")
    body = F.struct(
        F.col(channel).alias("channel_id"),
        F.col(value).alias("channel_value"),
        F.unix_millis(at).alias("timestamp"),
    )
    return frame.select(F.to_json(body).alias("value"), at.alias("timestamp"))
