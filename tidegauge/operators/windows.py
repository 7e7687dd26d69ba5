"""Tumbling event-time windows per channel, on tables and on streams.

Counts, means, extremes and deviations merge partial results made before the
shuffle, so a channel with a large share of the rows costs its task one partial
row per map task and window.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.expressions import interval_text, same_key, stable_round
from tidegauge.operators.readings import joined_parts, ordered_list, readings_parts
from tidegauge.plans.skew import group_sizes, rows_per_task

# Fixed value: the window of the report.
REPORT_WINDOW = timedelta(minutes=5)
_AT = ["channel_id", "window_start", "window_end"]


def tumbling(time: str, size: timedelta) -> Column:
    """Half-open windows of ``size``, aligned to the epoch."""
    return F.window(time, interval_text(size)).alias("window")


def _channel(name: str) -> Column:
    return F.col(name).cast("string").alias("channel_id")


def _statistics(value: str) -> dict[str, Column]:
    return {
        "totalReadings": F.count(value),
        "averageReading": stable_round(F.avg(value)),
        "maxReading": F.round(F.max(value), 1),
        "minReading": F.round(F.min(value), 1),
        "stdReading": stable_round(F.stddev_samp(value)),
    }


def _grouped(
    frame: DataFrame, channel: str, time: str, size: timedelta, results: dict[str, Column]
) -> DataFrame:
    """One row per channel and window: its bounds, the constant frequency, ``results``."""
    return (
        frame.groupBy(_channel(channel), tumbling(time, size))
        .agg(*[column.alias(name) for name, column in results.items()])
        .select(
            "channel_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            F.lit(1).cast("double").alias("hourly_frequency"),
            *results,
        )
    )


def tumbling_statistics(
    frame: DataFrame, channel: str, time: str, value: str, size: timedelta = REPORT_WINDOW
) -> DataFrame:
    """Count, mean, maximum, minimum and sample deviation per channel and window."""
    return _grouped(frame, channel, time, size, _statistics(value))


def _window_sizes(frame: DataFrame, channel: str, time: str, size: timedelta):
    """Group sizes, and whether the largest window is too big to gather in one task.

    Gathered readings are held as objects, several windows at a time, so the
    limit is an eighth of what a sorted task may take.
    """
    sizes = group_sizes(frame, [_channel(channel), tumbling(time, size)])
    return sizes, sizes.largest > rows_per_task(frame.sparkSession) // 8


def readings_list(
    frame: DataFrame,
    channel: str,
    time: str,
    value: str,
    tie: str | None = None,
    size: timedelta = REPORT_WINDOW,
) -> DataFrame:
    """Per channel and window: the count and the ordered list of readings."""
    count = {"totalReadings": F.count(value)}
    if not frame.isStreaming:
        sizes, split = _window_sizes(frame, channel, time, size)
        if split:
            counts = _grouped(frame, channel, time, size, count)
            lists = joined_parts(
                readings_parts(frame, channel, time, value, tie, size, sizes.total)
            )
            return _with_lists(counts, lists).drop("hourly_frequency")
    both = {**count, "readingsList": ordered_list(time, tie, value)}
    return _grouped(frame, channel, time, size, both).drop("hourly_frequency")


def _with_lists(results: DataFrame, lists: DataFrame) -> DataFrame:
    """Add the lists; a window without readings has none."""
    same = same_key([results[c] for c in _AT], [lists[c] for c in _AT])
    return results.join(lists, same, "left").select(results["*"], "readingsList")


def tumbling_report(
    frame: DataFrame,
    channel: str,
    time: str,
    value: str,
    tie: str | None = None,
    size: timedelta = REPORT_WINDOW,
) -> DataFrame:
    """The full report, with the columns and the column order of the sink."""
    results = _statistics(value)
    order = [*_AT, "hourly_frequency", "totalReadings", "readingsList", *list(results)[1:]]
    if not frame.isStreaming:
        sizes, split = _window_sizes(frame, channel, time, size)
        if split:
            statistics = _grouped(frame, channel, time, size, results)
            parts = readings_parts(frame, channel, time, value, tie, size, sizes.total)
            return _with_lists(statistics, joined_parts(parts)).select(*order)
    results["readingsList"] = ordered_list(time, tie, value)
    return _grouped(frame, channel, time, size, results).select(*order)


def tumbling_count(
    frame: DataFrame, key: str, time: str, size: timedelta = timedelta(milliseconds=5)
) -> DataFrame:
    """Rows per key and window; bounds as epoch milliseconds."""

    def bound(name: str) -> Column:
        return F.unix_millis(F.col(f"window.{name}").cast("timestamp")).alias(name)

    return (
        frame.groupBy(key, tumbling(time, size))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(key, bound("start"), bound("end"), "count")
    )
