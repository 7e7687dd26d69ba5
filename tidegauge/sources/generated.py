"""Synthetic measurements, a pure function of a sequence number.

Every column is computed from the number and a seed, so the rows do not depend
on partitioning, and a lost task makes the same rows again.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Channels and value range of the measurement generator.
CHANNELS = 10
LOWEST, HIGHEST = 10, 2000
LEAD = timedelta(milliseconds=500)


def synthetic_measurements(
    sequence: DataFrame,
    number: str,
    first_ms: int | Column,
    step: timedelta = timedelta(seconds=3),
    seed: int = 0,
) -> DataFrame:
    """One measurement per row of ``sequence``: channel_id, channel_value, timestamp.

    Channels 1 to 10 take turns, values are uniform integers from 10 to 2000,
    and times advance by ``step``, half a second ahead of ``first_ms``.
    """
    n = F.col(number)
    start = F.lit(first_ms) if isinstance(first_ms, int) else first_ms
    millisecond = timedelta(milliseconds=1)
    drawn = F.pmod(F.xxhash64(n, F.lit(seed)), F.lit(HIGHEST - LOWEST + 1))
    return sequence.select(
        (F.pmod(n, F.lit(CHANNELS)) + 1).cast("bigint").alias("channel_id"),
        (drawn + LOWEST).alias("channel_value"),
        (start + n * (step // millisecond) + LEAD // millisecond).alias("timestamp"),
    )


def measurement_table(spark: SparkSession, rows: int, first_ms: int, **options) -> DataFrame:
    """``rows`` synthetic measurements, made in parallel."""
    return synthetic_measurements(spark.range(rows), "id", first_ms, **options)


def measurement_stream(spark: SparkSession, rows_per_second: int, seed: int = 0) -> DataFrame:
    """An endless stream of synthetic measurements, stamped with the time of making."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    now = F.unix_millis("timestamp")
    return synthetic_measurements(ticks, "value", now, timedelta(0), seed)


def as_messages(measurements: DataFrame) -> DataFrame:
    """Measurements as one JSON text per row, ready for a topic or a file."""
    return measurements.select(F.to_json(F.struct(*measurements.columns)).alias("value"))
