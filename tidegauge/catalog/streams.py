"""Queries on streams, run until their source is used up."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.catalog import batch
from tidegauge.catalog.registry import query
from tidegauge.functions.expressions import as_schema, epoch_micros, micros
from tidegauge.operators.alerts import decoded_transactions, threshold_alerts
from tidegauge.operators.transforms import nonzero
from tidegauge.operators.windows import REPORT_WINDOW, tumbling_count, tumbling_report
from tidegauge.plans.shared import new_folder
from tidegauge.schemas import REPORT
from tidegauge.sinks.writers import alert_messages, json_messages, read_back, report_messages
from tidegauge.sources.measurements import decoded_measurements, encoded_measurements
from tidegauge.sources.tables import table, table_stream
from tidegauge.streaming import carried, jobs
from tidegauge.streaming.drain import END_OF_TIME, drained, drained_to_the_end, run_to_the_end
from tidegauge.streaming.fanout import fan_out, sink_rows
from tidegauge.streaming.views import REPORT_TEXT, sql_stream


def times(spark, folder, name="events", time="ts"):
    """The first and the last time of a table in microseconds, None for an empty one."""
    at = epoch_micros(time)
    first, last = table(spark, folder, name).agg(F.min(at), F.max(at)).first()
    return first, last


def disorder(first, last):
    """How late a row of a table may come, whatever the order of its files.

    That is the span of all times, and a second more, as a row right at the watermark
    is late.  Times so far apart that the last rows would wait for ever are an error.
    """
    if first is None:
        return timedelta(seconds=1)
    lateness = timedelta(microseconds=last - first) + timedelta(seconds=1)
    # Beyond the lateness a row waits for the end of its slot, and windows for theirs.
    waits = timedelta(microseconds=last) + 1.25 * lateness + timedelta(days=1)
    if waits >= END_OF_TIME - datetime(1970, 1, 1):
        raise ValueError("the times are too far apart to be put in order as a stream")
    return lateness


def _measurements(spark, folder, channel):
    """Events as a stream of JSON messages, decoded."""
    events = table_stream(spark, folder, "events")
    return decoded_measurements(encoded_measurements(events, channel, "value", "ts"))


def _waited(spark, stream, schema, start, time="ts"):
    """The rows of ``start(stream, folder, checkpoint)``, run to the end."""
    out, progress = new_folder(spark, "carried"), new_folder(spark, "progress")
    run_to_the_end(stream, time, lambda whole: start(whole, out, progress))
    return carried.results(spark, out, progress, schema)


def closed_windows(spark, stream, time, size, windowed, schema, lateness):
    """All windows of a table's stream, whatever the order and number of its files."""

    def start(rows, out, progress):
        return carried.windows_in_batches(rows, time, size, windowed, out, progress, lateness)

    return _waited(spark, stream, schema, start, time)


_CLOSED_REPORTS_SQL = """
    WITH measured AS (
        SELECT event_type AS channel_id, value, epoch_us(ts) // 1000 AS ms FROM events),
    reported AS (
        SELECT channel_id,
            time_bucket(INTERVAL 5 MINUTE, make_timestamp(ms * 1000)) AS window_start,
            time_bucket(INTERVAL 5 MINUTE, make_timestamp(ms * 1000)) + INTERVAL 5 MINUTE
                AS window_end,
            1.0::DOUBLE AS hourly_frequency,
            count(value) AS "totalReadings",
            round(round(avg(value), 6), 1) AS "averageReading",
            round(max(value), 1) AS "maxReading",
            round(min(value), 1) AS "minReading",
            round(round(stddev_samp(value), 6), 1) AS "stdReading",
            string_agg(value::VARCHAR, ',' ORDER BY ms, value) AS "readingsList"
        FROM measured GROUP BY ALL)
    SELECT * FROM reported
    WHERE window_end <= (SELECT make_timestamp(max(ms) * 1000) FROM measured) - INTERVAL 30 SECOND
    """


@query(_CLOSED_REPORTS_SQL)
def stream_tumble_report(spark, folder):
    """JSON in, five-minute reports out as JSON, read back to columns."""
    first, last = times(spark, folder)
    stream = _measurements(spark, folder, "event_type")
    stream = stream.select("channel_id", "event_time", "channel_value")

    def windowed(rows):
        return as_schema(tumbling_report(rows, "channel_id", "event_time", "channel_value"), REPORT)

    report = closed_windows(
        spark, stream, "event_time", REPORT_WINDOW, windowed, REPORT, disorder(first, last)
    )
    # As at the watermark that the whole table leaves behind.
    behind = jobs.REPORT_DELAY
    passed = F.timestamp_millis(F.lit((last or 0) // 1000)).cast("timestamp_ntz")
    report = report.where(F.col("window_end") <= passed - behind)
    return read_back(report_messages(report), REPORT)


@query(_CLOSED_REPORTS_SQL)
def stream_report_sql(spark, folder):
    """The report as SQL text over a view of the stream; open windows stay in the state."""
    first, last = times(spark, folder)
    lateness = disorder(first, last)
    stream = _measurements(spark, folder, "event_type")
    stream = stream.select("channel_id", "event_time", "channel_value")

    def rule(rows):
        timed = jobs.watermarked(rows, "event_time", lateness)
        return sql_stream(spark, REPORT_TEXT, {"measurements": timed}, REPORT)

    report = drained_to_the_end(stream, "event_time", rule)
    passed = F.timestamp_millis(F.lit((last or 0) // 1000)).cast("timestamp_ntz")
    return report.where(F.col("window_end") <= passed - jobs.REPORT_DELAY)


@query(
    f"""
    SELECT 'alerts' AS sink, fraud_result AS "value" FROM ({batch.ALERT_SQL})
    UNION ALL
    SELECT 'cleaned', event_type || ',' || event_id || ',' || (epoch_us(ts) // 1000)
    FROM events WHERE value <> 0
    """
)
def stream_two_sinks(spark, folder):
    """One reading of the stream, alerts to one sink and cleaned measurements to another."""
    stream = table_stream(spark, folder, "events").select("event_id", "event_type", "ts", "value")

    def alerts(rows):
        found = threshold_alerts(rows, "event_id", "value", batch.FIXTURE_THRESHOLD)
        return found.select(F.col("fraud_result").alias("value"))

    def cleaned(rows):
        at = F.unix_millis(F.col("ts").cast("timestamp"))
        return nonzero(rows, "value").select(
            F.concat_ws(",", "event_type", "event_id", at).alias("value")
        )

    out, progress = new_folder(spark, "sinks"), new_folder(spark, "progress")
    sinks = {"alerts": alerts, "cleaned": cleaned}
    fan_out(stream, sinks, out, progress).awaitTermination()
    kind = T.StructType([T.StructField("value", T.StringType())])
    parts = [
        sink_rows(spark, out, name, progress, kind).select(F.lit(name).alias("sink"), "value")
        for name in sinks
    ]
    return parts[0].unionByName(parts[1])


@query(
    """
    SELECT * FROM (
        SELECT user_id,
            epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) // 1000 AS "start",
            epoch_us(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR) // 1000 AS "end",
            count(*) AS "count"
        FROM events GROUP BY ALL)
    WHERE "end" <= (SELECT max(epoch_us(ts) // 1000) FROM events)
    """
)
def stream_tumble_count(spark, folder):
    first, last = times(spark, folder)
    stream, size = table_stream(spark, folder, "events").select("user_id", "ts"), timedelta(hours=1)
    counts = closed_windows(
        spark,
        stream,
        "ts",
        size,
        lambda rows: tumbling_count(rows, "user_id", "ts", size),
        tumbling_count(table(spark, folder, "events"), "user_id", "ts", size).schema,
        disorder(first, last),
    )
    return counts.where(F.col("end") <= (last or 0) // 1000)


# Rules that follow a channel: all rows wait until the table's end, so they wait in a table
# and not in one task's state, and a channel too large for a task is split.


def _event_stream(spark, folder, key, *columns):
    return table_stream(spark, folder, "events").select("event_id", key, "ts", *columns)


def followed_throttle(spark, folder, key):
    stream, lateness = _event_stream(spark, folder, key, "value"), disorder(*times(spark, folder))

    def start(rows, out, progress):
        return carried.throttle_in_batches(
            rows, [key], "ts", ["event_id"], out, progress, timedelta(hours=6), lateness
        )

    return _waited(spark, stream, stream.schema, start)


def followed_gap(spark, folder, key):
    stream, lateness = _event_stream(spark, folder, key), disorder(*times(spark, folder))
    before = T.StructField("last_recorded_timestamp", stream.schema["ts"].dataType)

    def start(rows, out, progress):
        return carried.gap_in_batches(
            rows, [key], "ts", ["event_id"], out, progress, lateness=lateness
        )

    return _waited(spark, stream, T.StructType([*stream.schema, before]), start)


def followed_sum(spark, folder, key):
    stream, lateness = _event_stream(spark, folder, key, "value"), disorder(*times(spark, folder))
    total = T.StructField("total", T.DoubleType())

    def start(rows, out, progress):
        return carried.running_sum_in_batches(
            rows, [key], "ts", ["event_id"], "value", "total", out, progress, lateness
        )

    summed = _waited(spark, stream, T.StructType([*stream.schema, total]), start)
    return summed.select("event_id", key, F.round("total", 2).alias("total"))


@query(batch.throttle_sql("user_id", "6 HOUR"))
def stream_throttle(spark, folder):
    return followed_throttle(spark, folder, "user_id")


@query(batch.gap_sql("user_id"))
def stream_lag_gap(spark, folder):
    return followed_gap(spark, folder, "user_id")


@query(batch.rolling_sql("user_id"))
def stream_rolling_sum(spark, folder):
    return followed_sum(spark, folder, "user_id")


@query(
    """
    SELECT DISTINCT user_id, epoch_us(ts) // 1000 + 2000 AS fired_at,
        round(sum(value) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000
            RANGE BETWEEN UNBOUNDED PRECEDING AND 2000 FOLLOWING), 2) AS total
    FROM events
    QUALIFY fired_at <= (SELECT max(epoch_us(ts) // 1000) FROM events) - 2000
    """
)
def stream_timer_sum(spark, folder):
    """Timers two seconds behind every row, each with the sum at its time."""
    first, last = times(spark, folder)
    stream = table_stream(spark, folder, "events").select("user_id", "ts", "value")
    fields = [
        stream.schema["user_id"],
        T.StructField("fired_at", T.LongType()),
        T.StructField("total", T.DoubleType()),
    ]

    def start(rows, out, progress):
        return carried.timed_sum_in_batches(
            rows, "user_id", "ts", "value", out, progress, lateness=disorder(first, last)
        )

    fired = _waited(spark, stream, T.StructType(fields), start)
    behind = micros(jobs.TIMER_LATENESS) // 1000
    fired = fired.where(F.col("fired_at") <= (last or 0) // 1000 - behind)
    return fired.withColumn("total", F.round("total", 2))


@query(batch.ALERT_SQL.replace("fraud_result", '"value"'))
def stream_alerts(spark, folder):
    events = table_stream(spark, folder, "events")
    raw = json_messages(
        events.select(F.col("event_id").alias("transaction_id"), F.col("value").alias("amount"))
    )
    alerts = threshold_alerts(decoded_transactions(raw), threshold=batch.FIXTURE_THRESHOLD)
    return drained(alert_messages(alerts), kind="text")
