"""Streams: closed windows, late rows, restarts, state, and parity with tables."""

import json
import os
import time
from collections import Counter
from datetime import datetime, timedelta
from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracle import connected, oracle_rows, spark_rows
from tidegauge.catalog import ORACLES, QUERIES, split, streams
from tidegauge.functions.expressions import instant
from tidegauge.operators.gaps import gap_filter
from tidegauge.operators.rolling import running_sum
from tidegauge.operators.throttle import throttle
from tidegauge.operators.windows import tumbling_report
from tidegauge.sinks.writers import stream_writer, to_console, to_files, to_table
from tidegauge.sources.measurements import decoded_measurements
from tidegauge.sources.tables import table_stream
from tidegauge.sources.text import message_file_stream, message_files
from tidegauge.streaming import carried, jobs
from tidegauge.streaming.drain import drained, drained_to_the_end, run_to_the_end
from tidegauge.streaming.fanout import fan_out, sink_rows
from tidegauge.streaming.views import sql_stream

BASE = 1_700_000_100_000  # 2023-11-14 22:15:00 UTC


def clock(seconds):
    """Times from 1970-01-02 on: what is not behind the epoch is late to any watermark."""
    return instant((F.col(seconds) + 86_400) * 1000)


def message(channel, value, offset):
    return json.dumps({"channel_id": channel, "channel_value": value, "timestamp": BASE + offset})


def write_files(folder, files):
    """One file per list of lines, with rising modification times."""
    folder.mkdir(exist_ok=True)
    for number, lines in files.items():
        path = folder / f"{number:03d}.txt"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_600_000_000 + number, 1_600_000_000 + number))
    return str(folder)


LATE_FILES = {
    1: [message(1, 10, 0), message(1, 20, 60_000), message(2, 5, 1000), "junk"],
    2: [message(1, 30, 400_000)],
    3: [message(1, 99, 2000), message(2, 7, 800_000)],
}


def measurements(spark, folder):
    return decoded_measurements(message_file_stream(spark, folder, files_per_batch=1))


def timed_rows(spark, folder, files):
    """Rows (k, s, v, id) as a stream of one file per micro-batch, with an event time."""
    frame = spark.readStream.schema("k string, s bigint, v double, id bigint")
    path = write_files(folder, {n: [json.dumps(r) for r in rows] for n, rows in files.items()})
    stream = frame.option("maxFilesPerTrigger", 1).json(path)
    return stream.withColumn("at", clock("s")), path


def in_thirds(rows):
    third = len(rows) // 3
    return {1: rows[:third], 2: rows[third : 2 * third], 3: rows[2 * third :]}


READINGS = [
    {"k": "ab"[i % 7 == 0], "s": 40 * i + (i * 37) % 90, "v": float(i % 11), "id": i}
    for i in range(120)
]
READINGS.sort(key=lambda r: r["s"])


def test_windows_close_behind_the_watermark(spark, tmp_path):
    folder = write_files(tmp_path / "in", LATE_FILES)
    report = drained(jobs.report_stream(measurements(spark, folder)))
    found = {
        (r.channel_id, r.window_start.strftime("%H:%M")): (r.totalReadings, r.averageReading)
        for r in report.collect()
    }
    assert {k: n for k, (n, _) in found.items()} == {
        ("1", "22:15"): 3,
        ("2", "22:15"): 1,
        ("1", "22:20"): 1,
    }


def test_closed_windows_equal_the_table_report(spark, tmp_path):
    files = {
        n: [message(i % 3, 10 * i, 45_000 * i) for i in range(8 * n - 8, 8 * n)] for n in (1, 2, 3)
    }
    folder = write_files(tmp_path / "in", files)
    streamed = drained(jobs.report_stream(measurements(spark, folder))).collect()
    table = decoded_measurements(message_files(spark, folder))
    whole = tumbling_report(table, "channel_id", "event_time", "channel_value")
    last = datetime.fromtimestamp((BASE + 45_000 * 23) / 1000) - timedelta(seconds=30)
    closed = [r for r in whole.collect() if r.window_end <= last]
    assert closed and sorted(map(tuple, streamed)) == sorted(map(tuple, closed))


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    folder, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    for number in (1, 2, 3):
        write_files(folder, {number: LATE_FILES[number]})
        report = jobs.report_stream(measurements(spark, str(folder)))
        to_files(report, out, progress).awaitTermination()
    found = spark.read.parquet(out).select("channel_id", "totalReadings").collect()
    # Each run closes what it can, so the late row of the third file finds its
    # window gone; the open windows lived on in the checkpoint.
    assert sorted(map(tuple, found)) == [("1", 1), ("1", 2), ("2", 1)]


def test_two_jobs_on_one_source(spark, tmp_path):
    folder = write_files(tmp_path / "in", LATE_FILES)
    with jobs.keyed_state(spark):
        first = to_files(
            jobs.report_stream(measurements(spark, folder)),
            str(tmp_path / "report"), str(tmp_path / "p1"),
        )
        cleaned = jobs.throttle_stream(measurements(spark, folder), ["channel_id"], "event_time")
        second = to_files(cleaned, str(tmp_path / "cleaned"), str(tmp_path / "p2"))
    first.awaitTermination()
    second.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "report")).count() == 3
    kept = spark.read.parquet(str(tmp_path / "cleaned")).select("channel_id", "channel_value")
    # The newest row still waits for the watermark.
    assert sorted(map(tuple, kept.collect())) == [("1", 10.0), ("1", 30.0), ("2", 5.0)]


def test_ascending_counts_drop_late_rows(spark, tmp_path):
    early = [("x", t) for t in (0, 4, 5, 9, 10, 10, 31)] + [("y", 18), ("z", 44)]
    late = [("y", t) for t in (3, 3, 7)]
    # A row is late against the watermark of the micro-batch before its own.
    files = {1: early, 2: [("end", 60)], 3: late, 4: [("end", 100)]}
    lines = {n: [json.dumps({"k": k, "t": t}) for k, t in rows] for n, rows in files.items()}
    path = write_files(tmp_path / "in", lines)
    stream = spark.readStream.schema("k string, t bigint").option("maxFilesPerTrigger", 1).json(path)
    counted = drained(jobs.count_stream(stream.withColumn("at", instant("t")), "k", "at"))
    found = {(r.k, r.start): r["count"] for r in counted.collect() if r.k != "end"}
    assert found == Counter((k, t // 5 * 5) for k, t in early)


def shuffled(rows):
    """Rows in no order of time, in three files."""
    return in_thirds([rows[(i * 37) % len(rows)] for i in range(len(rows))])


WHOLE_SPAN = timedelta(hours=2)
READINGS_SCHEMA = "k string, s bigint, v double, id bigint"


@pytest.mark.parametrize("files", [in_thirds(READINGS), shuffled(READINGS)])
@pytest.mark.parametrize("rule", ["throttle", "gap", "sum"])
def test_state_over_several_batches_equals_the_table(spark, tmp_path, rule, files):
    stream, path = timed_rows(spark, tmp_path / "in", files)
    table = spark.read.schema(READINGS_SCHEMA).json(path)
    table = table.withColumn("at", clock("s"))
    expected, streamed = {
        "throttle": (
            throttle(table, ["k"], "at", ["id"]),
            lambda s: jobs.throttle_stream(s, ["k"], "at", ["id"], lateness=WHOLE_SPAN),
        ),
        "gap": (
            gap_filter(table, ["k"], "at", ["id"]),
            lambda s: jobs.gap_stream(s, ["k"], "at", ["id"], lateness=WHOLE_SPAN),
        ),
        "sum": (
            running_sum(table, ["k"], ["at", "id"], "v", "total"),
            lambda s: jobs.running_sum_stream(
                s, ["k"], "at", ["id"], "v", "total", lateness=WHOLE_SPAN
            ),
        ),
    }[rule]
    assert streamed(stream).schema == expected.schema or rule != "sum"
    found = drained_to_the_end(stream, "at", streamed).select(*expected.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("files", [in_thirds(READINGS), shuffled(READINGS)])
@pytest.mark.parametrize("rule", ["throttle", "gap", "sum"])
def test_carried_rows_over_several_batches_equal_the_table(
    spark, tmp_path, rows_per_task, rule, files
):
    stream, path = timed_rows(spark, tmp_path / "in", files)
    table = spark.read.schema(READINGS_SCHEMA).json(path)
    table = table.withColumn("at", clock("s"))
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    expected, start = {
        "throttle": (
            throttle(table, ["k"], "at", ["id"]),
            lambda s: carried.throttle_in_batches(
                s, ["k"], "at", ["id"], out, progress, lateness=WHOLE_SPAN
            ),
        ),
        "gap": (
            gap_filter(table, ["k"], "at", ["id"]),
            lambda s: carried.gap_in_batches(
                s, ["k"], "at", ["id"], out, progress, lateness=WHOLE_SPAN
            ),
        ),
        "sum": (
            running_sum(table, ["k"], ["at", "id"], "v", "total"),
            lambda s: carried.running_sum_in_batches(
                s, ["k"], "at", ["id"], "v", "total", out, progress, lateness=WHOLE_SPAN
            ),
        ),
    }[rule]
    rows = sorted(map(tuple, expected.collect()))
    rows_per_task(15)
    run_to_the_end(stream, "at", start)
    # What no commit vouches for is no result.
    expected.limit(1).write.parquet(f"{out}/rows/999")
    found = carried.results(spark, out, progress, expected.schema)
    assert sorted(map(tuple, found.collect())) == rows


@pytest.mark.parametrize("files_per_batch", [1, 2, 1000])
def test_throttle_does_not_depend_on_the_size_of_batches(spark, events, tmp_path, files_per_batch):
    events.orderBy(F.hash("event_id")).repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    stream = table_stream(spark, str(tmp_path), "events", files_per_batch)
    found = drained_to_the_end(
        stream,
        "ts",
        lambda s: jobs.throttle_stream(
            s, ["event_type"], "ts", ["event_id"], timedelta(hours=6), timedelta(days=60)
        ),
    )
    expected = throttle(events, ["event_type"], "ts", ["event_id"], timedelta(hours=6))
    assert sorted(r.event_id for r in found.collect()) == sorted(
        r.event_id for r in expected.collect()
    )


def test_gap_looks_at_the_latest_row_before(spark, tmp_path):
    rows = [{"k": "a", "s": s, "v": 0.0, "id": s} for s in (0, 90, 50, 100)]
    stream, _ = timed_rows(spark, tmp_path / "in", {1: rows[:2], 2: rows[2:]})
    gap = timedelta(seconds=45)
    found = drained_to_the_end(
        stream,
        "at",
        lambda s: jobs.gap_stream(s, ["k"], "at", ["id"], gap, lateness=timedelta(seconds=60)),
    )
    assert [r.s for r in found.collect()] == [50]


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    rows = [{"k": "a", "s": s, "v": 0.0, "id": s} for s in (1000, 2000, 3000, 10, 4000)]
    # A row is late against the watermark of the micro-batch before its own.
    files = {1: rows[:2], 2: rows[2:3], 3: rows[3:4], 4: rows[4:]}
    stream, _ = timed_rows(spark, tmp_path / "in", files)
    kept = jobs.throttle_stream(stream, ["k"], "at", ["id"])
    with jobs.keyed_state(spark):
        query = to_files(kept, str(tmp_path / "out"), str(tmp_path / "progress"))
    query.awaitTermination()
    dropped = [p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress]
    assert sum(dropped) == 1
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.s for r in found) == [1000, 2000, 3000]


@pytest.mark.parametrize("kind", ["bigint", "decimal(20,2)", "double"])
def test_running_sum_keeps_the_type_and_is_exact(spark, tmp_path, kind):
    values = [2**53, 1, 1] if kind != "double" else [float("nan"), 1, None]
    frame = spark.createDataFrame(
        [("a", s, str(v) if v is not None else None) for s, v in enumerate(values)],
        "k string, s bigint, v string",
    ).select("k", "s", F.col("v").cast(kind).alias("v"), clock("s").alias("at"))
    frame = frame.withColumn("raw", F.encode("k", "UTF-8")).withColumn("list", F.array("s"))
    frame = frame.withColumn("day", F.to_date("at"))
    frame.write.parquet(f"{tmp_path}/sums.parquet")
    stream = table_stream(spark, str(tmp_path), "sums", 1)
    expected = running_sum(frame, ["k"], ["at", "s"], "v", "total")
    found = drained_to_the_end(
        stream, "at", lambda s: jobs.running_sum_stream(s, ["k"], "at", ["s"], "v", "total")
    )
    assert found.schema["total"].dataType == expected.schema["total"].dataType
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_timers_report_the_sum(spark, tmp_path):
    rows = [(1000, "n", 4.5), (6000, "n", 1.0), (4000, "s", 0.25), (3000, "n", 2.0), (9000, "s", 8.0)]
    lines = [json.dumps({"ms": ms, "name": n, "amount": a}) for ms, n, a in rows]
    end = [json.dumps({"ms": 60_000, "name": "end", "amount": 0.0})]
    path = write_files(tmp_path / "in", {1: lines, 2: end})
    stream = spark.readStream.schema("ms bigint, name string, amount double")
    stream = stream.option("maxFilesPerTrigger", 1).json(path).withColumn("at", instant("ms"))
    fired = drained(jobs.timed_sum_stream(stream, "name", "at", "amount")).collect()
    found = sorted((r.name, r.fired_at, r.total) for r in fired)
    # All rows of a micro-batch are in the sum before its timers fire.
    assert found == sorted((n, ms + 2000, {"n": 7.5, "s": 8.25}[n]) for ms, n, _ in rows)


@pytest.fixture(params=[1, 2, 1000])
def shuffled_folder(request, spark, events, tmp_path, monkeypatch):
    """The events in four files in no order of time, so many files to a micro-batch."""
    for module in (streams, split):
        own = partial(table_stream, files_per_batch=request.param)
        monkeypatch.setattr(module, "table_stream", own, raising=False)
    mixed = events.orderBy(F.hash("event_id")).repartition(4, F.hash("event_id"))
    mixed.write.parquet(f"{tmp_path}/tables/events.parquet")
    return f"{tmp_path}/tables"


@pytest.mark.parametrize(
    "name",
    ["stream_tumble_report", "stream_tumble_count", "stream_timer_sum", "stream_report_sql",
     "stream_two_sinks", "stream_throttle", "stream_lag_gap", "stream_rolling_sum"],
)
def test_queries_do_not_depend_on_files_and_batches(spark, shuffled_folder, name):
    whole = connected("/root/testdata/sf0.001")
    assert spark_rows(QUERIES[name](spark, shuffled_folder)) == oracle_rows(whole, ORACLES[name])


def test_waiting_rows_are_written_once(spark, events, tmp_path):
    """Twenty micro-batches, in and out of order: as much is written as comes in."""
    place = tmp_path / "events.parquet"
    for n in range(20):
        part = events.where(F.pmod(F.hash("event_id"), F.lit(20)) == n).coalesce(1)
        part.write.mode("append").parquet(str(place))
    stream = table_stream(spark, str(tmp_path), "events", 1).select("event_id", "event_type", "ts", "value")
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    run_to_the_end(
        stream,
        "ts",
        lambda s: carried.running_sum_in_batches(
            s, ["event_type"], "ts", ["event_id"], "value", "total", out, progress, timedelta(days=40)
        ),
    )
    folders = sorted(p.name for p in (tmp_path / "out" / "waiting").iterdir())
    assert len(folders) == 21
    written = spark.read.parquet(f"{out}/waiting")
    assert written.count() == events.count() + 1  # and the row of the end
    assert len(list((tmp_path / "out" / "rows").iterdir())) == 1
    assert len(list((tmp_path / "out" / "carried").iterdir())) == 1


def test_slots_close_one_after_another(spark, tmp_path):
    """In order of time, rows are given out as their slots close; late ones are left out."""
    rows = [{"k": "a", "s": s, "v": 1.0, "id": s} for s in range(0, 400, 10)]
    late = {"k": "a", "s": 5, "v": 100.0, "id": -1}
    files = {n + 1: rows[8 * n : 8 * n + 8] for n in range(5)}
    files[5] = [*files[5], late]
    stream, path = timed_rows(spark, tmp_path / "in", files)
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    lateness = timedelta(seconds=40)

    def start(s):
        return carried.running_sum_in_batches(
            s, ["k"], "at", ["id"], "v", "total", out, progress, lateness
        )

    run_to_the_end(stream, "at", start)
    table = spark.read.schema(READINGS_SCHEMA).json(path).withColumn("at", clock("s"))
    expected = running_sum(table.where("id >= 0"), ["k"], ["at", "id"], "v", "total")
    found = carried.results(spark, out, progress, expected.schema)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert len(list((tmp_path / "out" / "rows").iterdir())) > 2


def test_timers_ahead_are_carried_on(spark, tmp_path):
    rows = [{"k": "ab"[i % 2], "s": 3 * i, "v": float(i), "id": i} for i in range(60)]
    stream, _ = timed_rows(spark, tmp_path / "in", in_thirds(rows))
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    ahead = timedelta(seconds=50)

    def start(s):
        return carried.timed_sum_in_batches(
            s, "k", "at", "v", out, progress, ahead, timedelta(seconds=8)
        )

    run_to_the_end(stream, "at", start)
    found = carried.results(
        spark, out, progress, T.StructType().add("k", "string").add("fired_at", "long").add("total", "double")
    )
    expected = [
        (r["k"], (r["s"] + 50 + 86_400) * 1000, sum(q["v"] for q in rows if q["k"] == r["k"] and q["s"] <= r["s"] + 50))
        for r in rows
    ]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_stream_columns_of_any_name_stay(spark, tmp_path):
    stream, path = timed_rows(spark, tmp_path / "in", in_thirds(READINGS))
    for name in ("_carried", "_sum", "slot", "_at"):
        own = stream.withColumn(name, F.concat(F.lit("own "), "id"))
        out, progress = str(tmp_path / f"out{name}"), str(tmp_path / f"progress{name}")
        schema = T.StructType([*own.schema, T.StructField("total", T.DoubleType())])
        run_to_the_end(
            own,
            "at",
            lambda s, out=out, progress=progress: carried.running_sum_in_batches(
                s, ["k"], "at", ["id"], "v", "total", out, progress, WHOLE_SPAN
            ),
        )
        found = carried.results(spark, out, progress, schema).collect()
        assert len(found) == len(READINGS) and all(r[name] == f"own {r['id']}" for r in found)


def test_two_sinks_read_every_file_once(spark, tmp_path):
    stream, _ = timed_rows(spark, tmp_path / "in", in_thirds(READINGS))
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    sinks = {"small": lambda rows: rows.where("v < 3"), "ids": lambda rows: rows.select("id", "k")}
    query = fan_out(stream, sinks, out, progress)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(READINGS)
    # What no commit vouches for is no result.
    spark.createDataFrame([(-1, "x")], "id long, k string").write.parquet(f"{out}/ids/rows/99")
    ids = sink_rows(spark, out, "ids", progress, T.StructType().add("id", "long").add("k", "string"))
    assert sorted(r.id for r in ids.collect()) == sorted(r["id"] for r in READINGS)
    small = sink_rows(spark, out, "small", progress, stream.schema)
    assert small.count() == sum(r["v"] < 3 for r in READINGS)


def test_sql_text_is_planned_against_the_sink(spark, tmp_path):
    stream, _ = timed_rows(spark, tmp_path / "in", in_thirds(READINGS))
    sink = T.StructType().add("name", "string").add("twice", "double")
    spark.range(3).createOrReplaceTempView("readings")
    views = {"readings": stream, "other": stream}
    made = sql_stream(spark, "SELECT k, 2 * v FROM readings WHERE v > 0", views, sink)
    assert made.isStreaming and made.schema == sink
    assert drained(made).count() == sum(r["v"] > 0 for r in READINGS)
    with pytest.raises(ValueError, match="columns"):
        sql_stream(spark, "SELECT k FROM readings", views, sink)
    assert spark.table("readings").count() == 3 and not spark.catalog.tableExists("other")
    spark.catalog.dropTempView("readings")


def test_console_prints_what_is_there(spark, tmp_path):
    stream, _ = timed_rows(spark, tmp_path / "in", in_thirds(READINGS))
    query = to_console(stream, str(tmp_path / "progress"))
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(READINGS)


def test_totals_in_update_mode(spark, tmp_path):
    stream, _ = timed_rows(spark, tmp_path / "in", in_thirds(READINGS))
    totals = jobs.totals_stream(stream, "k", "v", "total")
    seen = []

    def note(batch, number):
        seen.extend((number, r.k, r.total) for r in batch.collect())

    progress = str(tmp_path / "progress")
    stream_writer(totals, progress, mode="update").foreachBatch(note).start().awaitTermination()
    final = {}
    for _, key, total in sorted(seen):
        final[key] = total
    assert final == {
        k: sum(r["v"] for r in READINGS if r["k"] == k) for k in {r["k"] for r in READINGS}
    }
    assert len({number for number, _, _ in seen}) == 3


def test_idle_total_is_forgotten_by_the_wall_clock(spark, tmp_path):
    folder, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    stream, _ = timed_rows(spark, folder, {1: [{"k": "a", "s": 1, "v": 5.0, "id": 1}]})
    summed = jobs.running_sum_stream(
        stream, ["k"], "at", ["id"], "v", "total", ttl=jobs.TOTAL_TTL
    )
    with jobs.keyed_state(spark):
        query = to_files(summed, out, progress, every=timedelta(milliseconds=100))

    def totals(count):
        until = time.monotonic() + 60
        while time.monotonic() < until and query.isActive:
            if (tmp_path / "out" / "_spark_metadata").exists():
                written = spark.read.schema(summed.schema).parquet(out)
                found = sorted(r.total for r in written.collect())
                if len(found) == count:
                    return found
            time.sleep(0.3)
        return None

    try:
        assert totals(1) == [5.0]
        time.sleep(2)
        write_files(folder, {2: [json.dumps({"k": "a", "s": 2, "v": 7.0, "id": 2})]})
        assert totals(2) == [5.0, 7.0]
    finally:
        query.stop()


def test_stream_into_a_named_table(spark, tmp_path):
    stream, _ = timed_rows(spark, tmp_path / "in", in_thirds(READINGS))
    spark.sql(f"CREATE TABLE result_table (k STRING, v DOUBLE) USING parquet LOCATION '{tmp_path}/t'")
    to_table(stream.select("k", "v"), "result_table", str(tmp_path / "progress")).awaitTermination()
    assert spark.table("result_table").count() == len(READINGS)
    spark.sql("DROP TABLE result_table")


@pytest.fixture
def years_of_events(spark, tmp_path, monkeypatch):
    """A folder whose events span several years, each micro-batch one file, the latest first."""
    for module in (streams, split):
        own = partial(table_stream, files_per_batch=1)
        monkeypatch.setattr(module, "table_stream", own, raising=False)
    place = tmp_path / "events.parquet"
    for number, year in enumerate((2024, 2020, 2022, 2021)):
        rows = [
            (100 * number + i, f"e{i % 2}", i % 3, float(i), datetime(year, 1 + i % 12, 1 + i, 3))
            for i in range(25)
        ]
        fields = "event_id long, event_type string, user_id long, value double, ts timestamp_ntz"
        spark.createDataFrame(rows, fields).coalesce(1).write.mode("append").parquet(str(place))
        for file in place.glob("part-*"):
            if file.stat().st_mtime > 1_700_000_000:
                os.utime(file, (1_600_000_000 + number, 1_600_000_000 + number))
    return str(tmp_path)


@pytest.mark.parametrize("key", ["user_id", "event_type"])
@pytest.mark.parametrize("rule", ["throttle", "lag_gap", "rolling_sum"])
def test_queries_take_tables_of_many_years_in_any_order(spark, years_of_events, rule, key):
    events = spark.read.parquet(f"{years_of_events}/events.parquet")
    expected = {
        "throttle": lambda: throttle(events, [key], "ts", ["event_id"], timedelta(hours=6)),
        "lag_gap": lambda: gap_filter(events, [key], "ts", ["event_id"]),
        "rolling_sum": lambda: running_sum(events, [key], ["ts", "event_id"], "value", "total"),
    }[rule]()
    name = f"stream_{rule}" + ("_split" if key == "event_type" else "")
    got = QUERIES[name](spark, years_of_events)
    columns = [c for c in got.columns if c in expected.columns]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(
        map(tuple, expected.select(columns).collect())
    )


@pytest.mark.parametrize("rule", ["throttle", "lag_gap", "rolling_sum"])
def test_queries_split_a_large_channel(spark, monkeypatch, rows_per_task, rule):
    def one_task(*args, **options):
        raise AssertionError("one task holds all waiting rows of a key")

    for name in ("throttle_stream", "gap_stream", "running_sum_stream"):
        monkeypatch.setattr(streams.jobs, name, one_task)
    folder, name = "/root/testdata/sf0.001", f"stream_{rule}"
    rows_per_task(20)
    assert spark_rows(QUERIES[name](spark, folder)) == oracle_rows(connected(folder), ORACLES[name])
