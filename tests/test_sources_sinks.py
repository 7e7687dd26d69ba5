"""Decoding, generating, message options, and what sinks write."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.plans.shared import pinned, shared_folder, stored
from tidegauge.schemas import CLEANED, MEASUREMENT, REPORT
from tidegauge.sinks import writers
from tidegauge.sources import topics
from tidegauge.sources.generated import as_messages, measurement_stream, measurement_table
from tidegauge.sources.measurements import decoded_measurements, decoded_sensor_records
from tidegauge.sources.text import message_files


def decoded(spark, lines):
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    return decoded_measurements(raw.withColumn("timestamp", F.current_timestamp()))


def test_decoding_is_tolerant(spark):
    lines = [
        '{"channel_id": 3, "channel_value": 17, "timestamp": 1700000100000}',
        '{"channel_id": "4", "channel_value": "high", "timestamp": 1700000100001}',
        '{"timestamp": 1700000100002, "other": [1, 2]}',
        '{"channel_id": 5, "channel_value": 1.5}',
        '{"channel_id": 6, "timestamp": 1700000100003, "channel_val',
        "junk",
        "",
        None,
    ]
    found = decoded(spark, lines)
    assert found.columns == MEASUREMENT.fieldNames()
    assert sorted((r.timestamp, r.channel_id, r.channel_value) for r in found.collect()) == [
        (1700000100000, "3", 17.0),
        (1700000100001, "4", None),
        (1700000100002, None, None),
    ]


def test_sensor_records_keep_both_times(spark):
    lines = ['{"timestamp": 1700000000001, "value": 2}', '{"timestamp": 5, "value": "x"}',
             '{"value": 3}', "{", "", None]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    raw = raw.withColumn("timestamp", F.timestamp_millis(F.lit(1_800_000_000_000)))
    found = decoded_sensor_records(raw)
    assert found.columns == ["timestamp", "value", "event_time", "ts"]
    times = found.select("timestamp", "value", F.unix_millis("event_time"), F.unix_millis("ts"))
    assert sorted(map(tuple, times.collect())) == [
        (5, None, 5, 1_800_000_000_000),
        (1700000000001, 2.0, 1700000000001, 1_800_000_000_000),
    ]


def test_transport_time_of_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text('{"channel_id": 1, "channel_value": 2, "timestamp": 0}\n')
    found = decoded_measurements(message_files(spark, str(tmp_path))).first()
    assert abs(found.ts.timestamp() - (tmp_path / "a.txt").stat().st_mtime) < 1
    assert found.hourly_frequency is None


def test_generated_measurements(spark):
    made = measurement_table(spark, 10_000, 1_700_000_000_000, step=timedelta(seconds=1))
    counts = {r.channel_id: r["count"] for r in made.groupBy("channel_id").count().collect()}
    assert counts == {channel: 1000 for channel in range(1, 11)}
    low, high, distinct = made.agg(
        F.min("channel_value"), F.max("channel_value"), F.countDistinct("channel_value")
    ).first()
    assert low >= 10 and high <= 2000 and distinct > 1900
    again = measurement_table(spark, 10_000, 1_700_000_000_000, step=timedelta(seconds=1))
    assert made.exceptAll(again.repartition(7)).count() == 0
    first = json.loads(as_messages(made.where("timestamp = 1700000000500")).first().value)
    assert set(first) == {"channel_id", "channel_value", "timestamp"}
    assert measurement_stream(spark, 5).isStreaming


def test_topic_options():
    assert topics.source_options(topics.MEASUREMENTS_TOPIC, group=topics.MEASUREMENTS_GROUP) == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "channel.measurements",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10000000",
        "kafka.group.id": "group.channel.measurements",
    }
    assert topics.source_options("t", start="latest")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        topics.source_options("t", start="middle")
    assert writers.topic_options(topics.ALERTS_TOPIC, "h:1") == {
        "kafka.bootstrap.servers": "h:1",
        "topic": "output_topic",
    }


def test_report_message(spark):
    report = spark.sql(
        """SELECT '1' AS a, timestamp_ntz'2024-01-01 00:05:00' AS b,
            timestamp_ntz'2024-01-01 00:10:00' AS c, 1 AS d, 2 AS e, '1.0,2.0' AS f,
            1.5D AS g, 2.0D AS h, 1.0D AS i, CAST(NULL AS DOUBLE) AS j"""
    )
    text = writers.report_messages(report).first().value
    assert json.loads(text) == {
        "channel_id": "1",
        "window_start": "2024-01-01T00:05:00.000",
        "window_end": "2024-01-01T00:10:00.000",
        "hourly_frequency": 1.0,
        "totalReadings": 2,
        "readingsList": "1.0,2.0",
        "averageReading": 1.5,
        "maxReading": 2.0,
        "minReading": 1.0,
    }
    back = writers.read_back(writers.report_messages(report), REPORT).first()
    assert back.totalReadings == 2 and back.stdReading is None


def test_cleaned_message(spark):
    row = spark.sql("SELECT 7 AS user, timestamp_millis(1700000100123) AS at, 2 AS v")
    text = writers.cleaned_messages(row).first().value
    assert json.loads(text) == {
        "channel_id": "7",
        "ts": "2023-11-14T22:15:00.123Z",
        "channel_value": 2.0,
    }
    assert writers.read_back(writers.cleaned_messages(row), CLEANED).first().channel_id == "7"


def test_insert_into_a_named_table(spark, tmp_path):
    spark.sql(f"CREATE TABLE kept (x INT) USING parquet LOCATION '{tmp_path}/t'")
    for _ in range(2):
        writers.insert_into(spark.createDataFrame([(1,)], "x int"), "kept")
    assert spark.table("kept").count() == 2
    spark.sql("DROP TABLE kept")


def test_copies_go_to_the_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    frame = spark.range(10).withColumn("x", F.col("id") * 2)
    assert pinned(frame).count() == stored(frame).count() == 10
    assert shared_folder(spark) in stored(frame).inputFiles()[0]


def test_insert_goes_by_position(spark):
    from tidegauge.sinks.writers import insert_into

    spark.sql("CREATE TABLE IF NOT EXISTS kept_rows (a BIGINT, b STRING) USING parquet")
    try:
        insert_into(spark.sql("SELECT 7 AS x, 8.5D AS y"), "kept_rows")
        assert [tuple(r) for r in spark.table("kept_rows").collect()] == [(7, "8.5")]
    finally:
        spark.sql("DROP TABLE kept_rows")


def test_table_streams_read_folders(spark, tmp_path):
    from tidegauge.sources.tables import table_stream
    from tidegauge.streaming.drain import drained

    spark.range(40).repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    for cap in (1, 2, 1000):
        assert drained(table_stream(spark, str(tmp_path), "events", cap)).count() == 40
