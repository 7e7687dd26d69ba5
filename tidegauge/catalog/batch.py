"""Queries on whole tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.udfs import register_doubling, select_with
from tidegauge.operators import transforms
from tidegauge.operators.alerts import alert_text, decoded_transactions, threshold_alerts
from tidegauge.operators.gaps import gap_filter
from tidegauge.operators.processes import process_windows
from tidegauge.operators.rolling import delayed_running_sum, idle_reset_sum, running_sum
from tidegauge.operators.throttle import throttle
from tidegauge.operators.windows import (
    readings_list,
    tumbling_count,
    tumbling_report,
    tumbling_statistics,
)
from tidegauge.catalog.registry import query
from tidegauge.schemas import CLEANED, REPORT
from tidegauge.sinks.writers import (
    alert_messages,
    cleaned_messages,
    json_messages,
    read_back,
    report_messages,
)
from tidegauge.sources.generated import HIGHEST, LOWEST, as_messages, synthetic_measurements
from tidegauge.sources.measurements import decoded_measurements, decoded_sensor_records
from tidegauge.sources.tables import table

# The tables have no amount above 1000, so alerts are raised above 100 here.
FIXTURE_THRESHOLD = 100.0

_STATISTICS_SQL = """
    1.0::DOUBLE AS hourly_frequency,
    count(value) AS "totalReadings",
    round(round(avg(value), 6), 1) AS "averageReading",
    round(max(value), 1) AS "maxReading",
    round(min(value), 1) AS "minReading",
    round(round(stddev_samp(value), 6), 1) AS "stdReading"
"""


def _report_sql(channel: str, interval: str) -> str:
    return f"""
        SELECT {channel}::VARCHAR AS channel_id,
            time_bucket(INTERVAL {interval}, ts) AS window_start,
            time_bucket(INTERVAL {interval}, ts) + INTERVAL {interval} AS window_end,
            {_STATISTICS_SQL}
        FROM events GROUP BY ALL
    """


@query(_report_sql("event_type", "5 MINUTE"))
def tumble_report_5m(spark, folder):
    return tumbling_statistics(table(spark, folder, "events"), "event_type", "ts", "value")


@query(_report_sql("user_id", "1 DAY"))
def tumble_report_1d(spark, folder):
    events = table(spark, folder, "events")
    return tumbling_statistics(events, "user_id", "ts", "value", timedelta(days=1))


READINGS_SQL = """
    SELECT event_type AS channel_id,
        time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
        time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
        count(value) AS "totalReadings",
        string_agg(value::VARCHAR, ',' ORDER BY ts, event_id) AS "readingsList"
    FROM events GROUP BY ALL
"""


@query(READINGS_SQL)
def tumble_readings_list(spark, folder):
    events = table(spark, folder, "events")
    return readings_list(events, "event_type", "ts", "value", "event_id", timedelta(hours=1))


@query(
    f"""
    SELECT event_type AS channel_id,
        time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
        time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
        {_STATISTICS_SQL},
        string_agg(value::VARCHAR, ',' ORDER BY ts, event_id) AS "readingsList"
    FROM events GROUP BY ALL
    """
)
def report_json(spark, folder):
    """The full report as the sink writes it, read back to columns."""
    events = table(spark, folder, "events")
    report = tumbling_report(events, "event_type", "ts", "value", "event_id")
    return read_back(report_messages(report), REPORT)


@query(
    """
    SELECT user_id,
        epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) // 1000 AS "start",
        epoch_us(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR) // 1000 AS "end",
        count(*) AS "count"
    FROM events GROUP BY ALL
    """
)
def tumble_count(spark, folder):
    return tumbling_count(table(spark, folder, "events"), "user_id", "ts", timedelta(hours=1))


@query(
    """
    SELECT user_id,
        epoch_us(time_bucket(INTERVAL 5 MILLISECOND, ts)) // 1000 AS "start",
        epoch_us(time_bucket(INTERVAL 5 MILLISECOND, ts) + INTERVAL 5 MILLISECOND) // 1000 AS "end",
        count(*) AS "count"
    FROM events GROUP BY ALL
    """
)
def tumble_count_5ms(spark, folder):
    return tumbling_count(table(spark, folder, "events"), "user_id", "ts")


def rolling_sql(key: str) -> str:
    return f"""
        SELECT event_id, {key}, round(sum(value) OVER (
            PARTITION BY {key} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS total
        FROM events
    """


def rolled(frame, key: str):
    summed = running_sum(frame, [key], ["ts", "event_id"], "value", "total")
    return summed.select("event_id", key, F.round("total", 2).alias("total"))


@query(rolling_sql("user_id"))
def keyed_rolling_sum(spark, folder):
    return rolled(table(spark, folder, "events"), "user_id")


def throttle_sql(key: str, interval: str) -> str:
    return f"""
        WITH RECURSIVE kept(channel, ts) AS (
            SELECT {key}, min(ts) FROM events GROUP BY {key}
            UNION ALL
            SELECT k.channel, min(e.ts)
            FROM kept k JOIN events e
                ON e.{key} = k.channel AND e.ts >= k.ts + INTERVAL {interval}
            GROUP BY k.channel
        )
        SELECT e.event_id, e.{key}, e.ts, e.value
        FROM events e JOIN kept k ON e.{key} = k.channel AND e.ts = k.ts
    """


def throttled(frame, key: str, gap: timedelta):
    return throttle(frame.select("event_id", key, "ts", "value"), [key], "ts", ["event_id"], gap)


@query(throttle_sql("user_id", "240 SECOND"))
def channel_throttle(spark, folder):
    return throttled(table(spark, folder, "events"), "user_id", timedelta(seconds=240))


@query(throttle_sql("user_id", "6 HOUR"))
def channel_throttle_6h(spark, folder):
    return throttled(table(spark, folder, "events"), "user_id", timedelta(hours=6))


@query(
    f"""
    SELECT user_id::VARCHAR AS channel_id, date_trunc('millisecond', ts) AS ts,
        value AS channel_value
    FROM ({throttle_sql("user_id", "240 SECOND")})
    """
)
def cleaned_json(spark, folder):
    """Throttled measurements as the sink writes them, read back to columns."""
    kept = throttled(table(spark, folder, "events"), "user_id", timedelta(seconds=240))
    messages = cleaned_messages(kept.select("user_id", "ts", "value"))
    return read_back(messages, CLEANED).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def gap_sql(key: str) -> str:
    return f"""
        SELECT event_id, {key}, ts, last_recorded_timestamp FROM (
            SELECT *, lag(ts) OVER (PARTITION BY {key} ORDER BY ts, event_id)
                AS last_recorded_timestamp
            FROM events)
        WHERE ts - last_recorded_timestamp >= INTERVAL 60000 MILLISECOND
    """


def far_apart(frame, key: str):
    return gap_filter(frame.select("event_id", key, "ts"), [key], "ts", ["event_id"])


@query(gap_sql("user_id"))
def lag_gap_filter(spark, folder):
    return far_apart(table(spark, folder, "events"), "user_id")


@query(
    """
    SELECT event_id, ts, last_recorded_timestamp FROM (
        SELECT *, lag(ts) OVER (ORDER BY ts, event_id) AS last_recorded_timestamp FROM events)
    WHERE ts - last_recorded_timestamp >= INTERVAL 60000 MILLISECOND
    """
)
def lag_gap_global(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts")
    return gap_filter(events, [], "ts", ["event_id"])


@query(
    """
    SELECT event_id, user_id, "timestamp", last_recorded_timestamp FROM (
        SELECT *, lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp", event_id)
            AS last_recorded_timestamp
        FROM (SELECT event_id, user_id, epoch_us(ts) // 1000 AS "timestamp" FROM events))
    WHERE "timestamp" - last_recorded_timestamp >= 60000
    """
)
def lag_gap_epoch_ms(spark, folder):
    """The gap filter on whole epoch milliseconds, as sensors send them."""
    events = table(spark, folder, "events")
    at = F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp")
    return gap_filter(events.select("event_id", "user_id", at), ["user_id"], "timestamp", ["event_id"])


ALERT_SQL = """
    SELECT 'Suspicious Transaction: ' || event_id AS fraud_result FROM events WHERE value > 100.0
"""


@query(ALERT_SQL)
def alert_threshold(spark, folder):
    events = table(spark, folder, "events")
    return threshold_alerts(events, "event_id", "value", FIXTURE_THRESHOLD)


@query(ALERT_SQL)
def alert_text_filter(spark, folder):
    """Alert texts of all rows, empty where there is nothing to report, and the rest of them."""
    events = table(spark, folder, "events")
    text = alert_text("event_id", "value", FIXTURE_THRESHOLD).alias("fraud_result")
    return events.select(text).where("fraud_result <> ''")


@query(ALERT_SQL.replace("fraud_result", '"value"'))
def alert_json(spark, folder):
    """Alerts out of JSON transactions, as the text the sink writes."""
    events = table(spark, folder, "events")
    raw = json_messages(
        events.select(F.col("event_id").alias("transaction_id"), F.col("value").alias("amount"))
    )
    return alert_messages(threshold_alerts(decoded_transactions(raw), threshold=FIXTURE_THRESHOLD))


def delayed_sql(key: str) -> str:
    return f"""
        SELECT event_id, {key}, round(sum(value) OVER (
            PARTITION BY {key} ORDER BY ts
            RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 2 HOUR FOLLOWING), 2) AS total
        FROM events
    """


def delayed(frame, key: str):
    summed = delayed_running_sum(
        frame.select("event_id", key, "ts", "value"),
        [key], "ts", ["event_id"], "value", "total", timedelta(hours=2),
    )
    return summed.select("event_id", key, F.round("total", 2).alias("total"))


@query(delayed_sql("user_id"))
def delayed_running_sums(spark, folder):
    return delayed(table(spark, folder, "events"), "user_id")


def idle_sql(key: str, interval: str) -> str:
    return f"""
        WITH stepped AS (
            SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL {interval} THEN 1 ELSE 0 END AS restart
            FROM events WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id)),
        parted AS (
            SELECT *, sum(restart) OVER (
                PARTITION BY {key} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS part
            FROM stepped)
        SELECT event_id, {key}, round(sum(value) OVER (
            PARTITION BY {key}, part ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS total
        FROM parted
    """


def idle_reset(frame, key: str, idle: timedelta):
    summed = idle_reset_sum(
        frame.select("event_id", key, "ts", "value"),
        [key], "ts", ["event_id"], "value", "total", idle,
    )
    return summed.select("event_id", key, F.round("total", 2).alias("total"))


@query(idle_sql("user_id", "6 HOUR"))
def idle_reset_sums(spark, folder):
    return idle_reset(table(spark, folder, "events"), "user_id", timedelta(hours=6))


@query("SELECT event_id, value, value * 2 AS twice FROM events")
def map_double(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    return transforms.doubled(events, "value", "twice")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_discount FROM lineitem
    WHERE l_discount IS DISTINCT FROM 0
    """
)
def filter_nonzero(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return transforms.nonzero(lines, "l_discount")


@query(
    """
    SELECT doc_id, len(string_split(text, ' '))::INTEGER AS n_words,
        string_split(text, ' ')[1] AS first_word, string_split(text, ' ')[-1] AS last_word
    FROM documents
    """
)
def split_map(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return transforms.words(documents, "text", "words").select(
        "doc_id",
        F.size("words").alias("n_words"),
        F.element_at("words", 1).alias("first_word"),
        F.element_at("words", -1).alias("last_word"),
    )


@query(
    """
    SELECT word, count(*) AS n, count(DISTINCT doc_id) AS documents FROM (
        SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents)
    GROUP BY word
    """
)
def split_flat_map(spark, folder):
    """Words of all documents, summed up so that the result can be compared."""
    documents = table(spark, folder, "documents").select("text")
    return transforms.word_counts(documents, "text", "word", "n", "documents")


_PROPS = T.StructType([T.StructField("k", T.IntegerType())])


def _contacts(spark, folder):
    """Customers as (id, segment, info), info being a nested JSON document."""
    customer = table(spark, folder, "customer")
    address = F.struct(
        F.col("c_mktsegment").alias("country"), F.col("c_nationkey").cast("string").alias("city")
    )
    info = F.struct(
        F.col("c_name").alias("name"),
        F.col("c_custkey").cast("int").alias("tel"),
        address.alias("addr"),
    )
    return customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("segment"),
        F.to_json(info).alias("info"),
    )


_CONTACT_PATHS = {"name": "name", "tel": "tel", "country": "addr.country", "city": "addr.city"}


@query(
    """
    SELECT c_custkey AS id, c_mktsegment AS country, c_custkey::INTEGER AS tel FROM customer
    """
)
def json_extract(spark, folder):
    contacts = _contacts(spark, folder).select("id", "info")
    return transforms.json_fields(contacts, "info", {"country": "addr.country", "tel": "tel"}).drop(
        "info"
    )


@query("SELECT event_id, (props->>'k')::INTEGER AS k FROM events")
def json_extract_props(spark, folder):
    events = table(spark, folder, "events").select("event_id", "props")
    return transforms.json_fields(events, "props", {"k": "k"}, _PROPS).drop("props")


@query("SELECT event_id, (props->>'k')::INTEGER + 1 AS k FROM events")
def json_update_props(spark, folder):
    events = table(spark, folder, "events").select("event_id", "props")
    updated = transforms.json_incremented(events, "props", "k", _PROPS)
    return transforms.json_fields(updated, "props", {"k": "k"}, _PROPS).drop("props")


_UPDATED_SQL = """
    SELECT c_custkey AS id, c_name AS name, (c_custkey + 1)::INTEGER AS tel,
        c_mktsegment AS country, c_nationkey::VARCHAR AS city
    FROM customer
"""


@query(_UPDATED_SQL)
def json_update(spark, folder):
    updated = transforms.json_incremented(_contacts(spark, folder), "info")
    return transforms.json_fields(updated, "info", _CONTACT_PATHS).drop("info", "segment")


@query(_UPDATED_SQL + " WHERE c_mktsegment = 'BUILDING'")
def json_update_filtered(spark, folder):
    contacts = _contacts(spark, folder)
    updated = transforms.json_incremented_where(contacts, "segment = 'BUILDING'", "info")
    return transforms.json_fields(updated, "info", _CONTACT_PATHS).drop("info", "segment")


@query(
    """
    SELECT c_custkey AS id, c_mktsegment AS country, (sum(c_custkey) OVER (
        PARTITION BY c_mktsegment ORDER BY c_custkey ROWS UNBOUNDED PRECEDING))::BIGINT AS total
    FROM customer
    """
)
def json_keyed_sum(spark, folder):
    """Key nested documents by country and roll up their numbers."""
    contacts = _contacts(spark, folder).select("id", "info")
    fields = transforms.json_fields(contacts, "info", {"country": "addr.country", "tel": "tel"})
    return running_sum(fields, ["country"], ["id"], "tel", "total").select("id", "country", "total")


@query(
    """
    SELECT epoch_us(ts) // 1000 AS "timestamp", value,
        date_trunc('millisecond', ts) AS event_time,
        ts + INTERVAL 250 MILLISECOND AS ts,
        (epoch_us(ts) // 1000000)::BIGINT AS second
    FROM events WHERE event_type <> 'error'
    """
)
def sensor_records(spark, folder):
    """Sensor messages with both times: the body's, and that of a transport 250 ms later.

    The messages of 'error' rows are no JSON and are skipped.
    """
    events = table(spark, folder, "events")
    at = F.col("ts").cast("timestamp")
    body = F.to_json(F.struct(F.unix_millis(at).alias("timestamp"), "value"))
    text = F.when(F.col("event_type") == "error", F.lit("{")).otherwise(body)
    later = at + F.expr("INTERVAL 250 MILLISECOND")
    records = decoded_sensor_records(events.select(text.alias("value"), later.alias("timestamp")))
    return records.select(
        "timestamp",
        "value",
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_time").cast("bigint").alias("second"),
    )


@query(
    """
    SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
        time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
        count(*) AS elements, round(max(value) - min(value), 2) AS spread,
        arg_min(event_type, (epoch_us(ts), event_id)) AS first_type
    FROM events GROUP BY ALL
    """
)
def process_windows_1d(spark, folder):
    """A function over the rows of each user's day: their number, spread and first type."""
    fields = T.StructType(
        [
            T.StructField("elements", T.LongType()),
            T.StructField("low", T.DoubleType()),
            T.StructField("high", T.DoubleType()),
            T.StructField("first_at", T.LongType()),
            T.StructField("first_id", T.LongType()),
            T.StructField("first_type", T.StringType()),
        ]
    )

    def partial(rows):
        values = rows.column("value").to_pylist()
        first = min(zip(*(rows.column(c).to_pylist() for c in ("at", "event_id", "event_type")), strict=True))
        return {
            "elements": rows.num_rows, "low": min(values), "high": max(values),
            "first_at": first[0], "first_id": first[1], "first_type": first[2],
        }

    def merge(parts):
        parts = list(parts)
        first = min(parts, key=lambda p: (p["first_at"], p["first_id"]))
        return {
            "elements": sum(p["elements"] for p in parts),
            "low": min(p["low"] for p in parts),
            "high": max(p["high"] for p in parts),
            **{n: first[n] for n in ("first_at", "first_id", "first_type")},
        }

    events = table(spark, folder, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    columns = ["value", "at", "event_id", "event_type"]
    found = process_windows(
        events, "user_id", "ts", timedelta(days=1), columns, partial, merge, fields
    )
    spread = F.round(F.col("high") - F.col("low"), 2)
    return found.select(
        "user_id", "window_start", "window_end", "elements", spread.alias("spread"), "first_type"
    )


@query(
    """
    SELECT user_id::VARCHAR AS channel_id,
        CASE WHEN event_type <> 'signup' THEN value END AS channel_value,
        NULL::DOUBLE AS hourly_frequency,
        epoch_us(ts) // 1000 AS "timestamp",
        date_trunc('millisecond', ts) AS event_time
    FROM events WHERE event_type <> 'error'
    """
)
def json_ingest(spark, folder):
    """Messages with two kinds of damage: 'error' rows are cut short and get
    skipped, 'signup' rows carry text where the value belongs and keep the rest."""
    events = table(spark, folder, "events")
    at = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    number = F.when(kind == "signup", '"n/a"').otherwise(F.col("value").cast("string"))
    text = F.format_string(
        '{"timestamp":%d,"channel_id":%d,"channel_value":%s}', F.unix_millis(at), "user_id", number
    )
    cut = F.when(kind == "error", F.substring_index(text, ",", 2)).otherwise(text)
    raw = events.select(cut.alias("value"), at.alias("timestamp"))
    return decoded_measurements(raw).drop("ts").withColumn(
        "event_time", F.col("event_time").cast("timestamp_ntz")
    )


@query("SELECT p_partkey, (p_size * 2)::INTEGER AS doubled FROM part")
def udf_double_sql(spark, folder):
    register_doubling(spark, "my_udf")
    part = table(spark, folder, "part")
    return select_with(part, "sizes", "SELECT p_partkey, my_udf(p_size) AS doubled FROM sizes")


@query(
    """
    SELECT event_id % 10 + 1 AS channel_id, count(*) AS n, true AS in_bounds,
        min(1700000000500 + event_id * 3000) AS first_ms,
        max(1700000000500 + event_id * 3000) AS last_ms
    FROM events GROUP BY ALL
    """
)
def synthetic_measurements_summary(spark, folder):
    """One synthetic measurement per event, through JSON, summed up per channel."""
    sequence = table(spark, folder, "events").select("event_id")
    made = synthetic_measurements(sequence, "event_id", 1_700_000_000_000)
    body = "channel_id bigint, channel_value bigint, timestamp bigint"
    value = F.col("channel_value")
    return (
        read_back(as_messages(made), body)
        .groupBy("channel_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bool_and(value.between(LOWEST, HIGHEST)).alias("in_bounds"),
            F.min("timestamp").alias("first_ms"),
            F.max("timestamp").alias("last_ms"),
        )
    )
