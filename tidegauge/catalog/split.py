"""The queries that follow a channel, with the channel split over many tasks.

The tables here are small enough for one task per channel, so these set the
limit of rows per task to a sixteenth of the table.  They take the plan that a
channel with a large share of a very large table gets.
"""

from __future__ import annotations

from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import functions as F

from tidegauge.catalog import batch
from tidegauge.catalog.registry import query
from tidegauge.catalog.streams import followed_gap, followed_sum, followed_throttle
from tidegauge.operators.windows import readings_list
from tidegauge.plans.skew import ROWS_PER_TASK
from tidegauge.sources.tables import table

_SHARE = 16


@contextmanager
def small_tasks(spark, frame):
    """Limit a task to a sixteenth of the rows of ``frame``."""
    before = spark.conf.get(ROWS_PER_TASK, None)
    spark.conf.set(ROWS_PER_TASK, str(max(1, frame.count() // _SHARE)))
    try:
        yield frame
    finally:
        if before is None:
            spark.conf.unset(ROWS_PER_TASK)
        else:
            spark.conf.set(ROWS_PER_TASK, before)


@query(batch.rolling_sql("event_type"))
def keyed_rolling_sum_split(spark, folder):
    with small_tasks(spark, table(spark, folder, "events")) as events:
        return batch.rolled(events, "event_type")


@query(batch.delayed_sql("event_type"))
def delayed_running_sums_split(spark, folder):
    with small_tasks(spark, table(spark, folder, "events")) as events:
        return batch.delayed(events, "event_type")


@query(batch.idle_sql("event_type", "1 HOUR"))
def idle_reset_sums_split(spark, folder):
    with small_tasks(spark, table(spark, folder, "events")) as events:
        return batch.idle_reset(events, "event_type", timedelta(hours=1))


@query(batch.gap_sql("event_type"))
def lag_gap_filter_split(spark, folder):
    with small_tasks(spark, table(spark, folder, "events")) as events:
        return batch.far_apart(events, "event_type")


@query(batch.throttle_sql("event_type", "6 HOUR"))
def channel_throttle_split(spark, folder):
    with small_tasks(spark, table(spark, folder, "events")) as events:
        return batch.throttled(events, "event_type", timedelta(hours=6))


@query(
    """
    SELECT event_type AS channel_id,
        time_bucket(INTERVAL 30 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
        time_bucket(INTERVAL 30 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 30 DAY AS window_end,
        count(value) AS "totalReadings",
        string_agg(value::VARCHAR, ',' ORDER BY ts, event_id) AS "readingsList"
    FROM events GROUP BY ALL
    """
)
def tumble_readings_list_split(spark, folder):
    with small_tasks(spark, table(spark, folder, "events")) as events:
        return readings_list(events, "event_type", "ts", "value", "event_id", timedelta(days=30))


@query(batch.throttle_sql("event_type", "6 HOUR"))
def stream_throttle_split(spark, folder):
    with small_tasks(spark, table(spark, folder, "events")):
        return followed_throttle(spark, folder, "event_type")


@query(batch.gap_sql("event_type"))
def stream_lag_gap_split(spark, folder):
    with small_tasks(spark, table(spark, folder, "events")):
        return followed_gap(spark, folder, "event_type")


@query(batch.rolling_sql("event_type"))
def stream_rolling_sum_split(spark, folder):
    with small_tasks(spark, table(spark, folder, "events")):
        return followed_sum(spark, folder, "event_type")
