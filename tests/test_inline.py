"""Small inputs with results that can be read off the definitions."""

import json
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.functions.expressions import as_schema, instant, stable_round
from tidegauge.functions.udfs import register_doubling, select_with
from tidegauge.operators import transforms
from tidegauge.operators.alerts import alert_text, decoded_transactions, threshold_alerts
from tidegauge.operators.gaps import gap_filter
from tidegauge.operators.rolling import delayed_running_sum, idle_reset_sum, running_sum
from tidegauge.operators.throttle import throttle
from tidegauge.operators.windows import readings_list, tumbling_count, tumbling_report
from tidegauge.schemas import REPORT

PLACES = [("ada", 70, "NO", "Oslo"), ("ben", 12, "PE", "Lima"), ("cleo", 8, "NO", "Bergen"), ("dov", 501, "KE", "Nairobi")]
CONTACTS = [
    (i, json.dumps({"name": name, "tel": tel, "addr": {"country": country, "city": city}}))
    for i, (name, tel, country, city) in enumerate(PLACES, 1)
]
# Seconds, in no order; some instants are shared, one pause is exactly one second.
PAYMENTS = [
    (1000 * at, name, amount)
    for name, ats in {"north": (6, 1, 2, 9, 2), "south": (3, 15, 4, 5, 30, 7)}.items()
    for at, amount in zip(ats, (2.5, 40.0, 0.25, 7.0, 1.5, 3.0), strict=False)
]


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


@pytest.fixture
def contacts(spark):
    return spark.createDataFrame(CONTACTS, "id int, info string")


@pytest.fixture
def payments(spark):
    frame = spark.createDataFrame(PAYMENTS, "ms bigint, name string, amount double")
    return frame.withColumn("at", instant("ms"))


@pytest.fixture(params=[4_000_000, 2], ids=["whole", "split"])
def both_plans(request, rows_per_task):
    rows_per_task(request.param)


def test_map_doubles(spark):
    frame = spark.createDataFrame([(x,) for x in range(1, 6)], "x int")
    assert rows(transforms.doubled(frame, "x", "y")) == [(x, 2 * x) for x in range(1, 6)]


def test_filter_drops_zero_and_keeps_null(spark):
    frame = spark.createDataFrame([(x,) for x in [0, 1, 2, 3, 4, 5, None]], "x int")
    kept = [r.x for r in transforms.nonzero(frame, "x").collect()]
    assert kept == [1, 2, 3, 4, 5, None]


def test_split_as_map_and_flat_map(spark):
    texts = ["hello wide world", "streaming compute", "two  blanks"]
    frame = spark.createDataFrame([(s,) for s in texts], "s string")
    assert [r.w for r in transforms.words(frame, "s", "w").collect()] == [t.split(" ") for t in texts]
    exploded = [r.w for r in transforms.exploded_words(frame, "s", "w").collect()]
    assert exploded == [w for t in texts for w in t.split(" ")]


def test_json_update_keeps_other_fields(contacts):
    updated = transforms.json_incremented(contacts, "info")
    paths = {"name": "name", "tel": "tel", "country": "addr.country", "city": "addr.city"}
    found = rows(transforms.json_fields(updated, "info", paths).drop("info"))
    assert found == [(i, n, tel + 1, *place) for i, (n, tel, *place) in enumerate(PLACES, 1)]


def test_json_update_after_filter(contacts):
    updated = transforms.json_incremented_where(contacts, "id = 1", "info")
    found = transforms.json_fields(updated, "info", {"tel": "tel"}).drop("info")
    assert rows(found) == [(1, 71)]


def test_keyed_sum_of_nested_numbers(contacts, both_plans):
    fields = transforms.json_fields(contacts, "info", {"country": "addr.country", "tel": "tel"})
    summed = running_sum(fields, ["country"], ["id"], "tel", "total").select("id", "country", "total")
    assert rows(summed) == [(1, "NO", 70), (2, "PE", 12), (3, "NO", 78), (4, "KE", 501)]


def test_running_sum_is_null_until_the_first_value(spark, both_plans):
    data = [(1, None), (2, 5.0), (3, None), (4, 1.0)]
    frame = spark.createDataFrame([("k", *d) for d in data], "k string, t int, v double")
    summed = running_sum(frame, ["k"], ["t"], "v", "s").orderBy("t").collect()
    assert [r.s for r in summed] == [None, 5.0, 5.0, 6.0]


def test_running_sum_with_null_keys(spark, both_plans):
    data = [(None, 1, 1), ("a", 1, 10), (None, 2, 2), ("a", 2, 20), (None, 3, 3)]
    frame = spark.createDataFrame(data, "k string, t int, v int")
    summed = running_sum(frame, ["k"], ["t"], "v", "s").orderBy("k", "t").collect()
    assert [r.s for r in summed] == [1, 3, 6, 10, 30]


def test_five_millisecond_window_counts(spark):
    times = {"x": [0, 4, 5, 9, 10, 10, 31], "y": [3, 3, 18, 3], "z": [44]}
    data = [(key, t) for key, ts in times.items() for t in ts]
    frame = spark.createDataFrame(data, "key string, t int").withColumn(
        "at", instant(F.col("t").cast("bigint"))
    )
    counts = Counter((key, t // 5 * 5) for key, t in data)
    assert rows(tumbling_count(frame, "key", "at")) == sorted(
        (key, start, start + 5, n) for (key, start), n in counts.items()
    )


def test_delayed_sum(payments, both_plans):
    summed = delayed_running_sum(
        payments, ["name"], "at", ["amount"], "amount", "total", timedelta(seconds=2)
    )
    found = rows(summed.select("name", F.col("ms") + 2000, "total"))
    assert found == sorted(
        (name, ms + 2000, sum(a for t, n, a in PAYMENTS if n == name and t <= ms + 2000))
        for ms, name, _ in PAYMENTS
    )


def test_idle_reset_sum(payments, both_plans):
    summed = idle_reset_sum(
        payments, ["name"], "at", ["amount"], "amount", "total", timedelta(seconds=1)
    )
    expected, before = [], {}
    for ms, name, amount in sorted(PAYMENTS, key=lambda p: (p[1], p[0], p[2])):
        last, total = before.get(name, (ms, 0.0))
        total = amount + (total if ms - last <= 1000 else 0.0)
        before[name] = (ms, total)
        expected.append((name, ms, total))
    assert rows(summed.select("name", "ms", "total")) == sorted(expected)


@pytest.mark.parametrize("name", ["_at", "_AT", "_part", "_restart", "_carried", "_run", "_mark", "_sum", "out"])
def test_columns_of_any_name_stay(payments, both_plans, name):
    own = payments.withColumn(name, F.concat(F.lit("own "), "ms"))
    gap = timedelta(seconds=2)
    kept = {
        "throttle": throttle(own, ["name"], "at", ["amount"], gap),
        "idle": idle_reset_sum(own, ["name"], "at", ["amount"], "amount", "total", gap),
        "delayed": delayed_running_sum(own, ["name"], "at", ["amount"], "amount", "total", gap),
        "running": running_sum(own, ["name"], ["at", "amount"], "amount", "total"),
        "gap": gap_filter(own, ["name"], "at", ["amount"], gap),
    }
    for rule, found in kept.items():
        assert found.columns[: len(own.columns)] == own.columns, rule
        taken = found.select("ms", F.col(f"`{name}`")).collect()
        assert taken and all(row[1] == f"own {row[0]}" for row in taken), rule


def test_throttle(spark, both_plans):
    seconds = [0, 100, 239, 240, 400, 479, 480, 1000, 1000 + 86_400 + 10]
    frame = spark.createDataFrame([("c", s * 1000) for s in reversed(seconds)], "c string, ms bigint")
    kept = throttle(frame.withColumn("at", instant("ms")), ["c"], "at")
    assert sorted(r.ms // 1000 for r in kept.collect()) == [0, 240, 480, 1000, 87_410]


def test_throttle_drops_rows_without_time_and_refuses_no_gap(spark):
    frame = spark.createDataFrame([("c", 0), ("c", None)], "c string, ms bigint")
    timed = frame.withColumn("at", instant("ms"))
    assert [r.ms for r in throttle(timed, ["c"], "at").collect()] == [0]
    with pytest.raises(ValueError):
        throttle(timed, ["c"], "at", gap=timedelta(0))


@pytest.mark.parametrize("keys", [["c"], []], ids=["keyed", "global"])
def test_gap_filter(spark, both_plans, keys):
    frame = spark.createDataFrame(
        [("c", ms) for ms in [0, 59_999, 119_999, 120_000, 400_000]], "c string, ms bigint"
    ).withColumn("at", instant("ms"))
    found = gap_filter(frame, keys, "at")
    assert sorted(r.ms for r in found.collect()) == [119_999, 400_000]
    first = gap_filter(frame, keys, "at", keep_first=True)
    assert sorted(r.ms for r in first.collect()) == [0, 119_999, 400_000]


def test_alerts(spark):
    lines = [
        '{"transaction_id":"t1","amount":"1000.01"}',
        '{"transaction_id":"t2","amount":1000.0}',
        '{"transaction_id":"t3","amount":"abc"}',
        '{"amount":5000}',
        "junk",
        '{"transaction_id":"t4","amount":2000}',
    ]
    transactions = decoded_transactions(spark.createDataFrame([(x,) for x in lines], "value string"))
    expected = [("Suspicious Transaction: t1",), ("Suspicious Transaction: t4",)]
    assert rows(threshold_alerts(transactions)) == expected
    texts = transactions.select(alert_text("transaction_id", "amount").alias("fraud_result"))
    assert rows(texts.where("fraud_result <> ''")) == expected


def test_udf_keeps_null(spark):
    register_doubling(spark)
    frame = spark.createDataFrame([(1,), (2,), (None,)], "column_name int")
    found = select_with(frame, "my_table", "SELECT my_udf(column_name) AS y FROM my_table")
    assert [r.y for r in found.collect()] == [2, 4, None]
    assert found.schema["y"].dataType.simpleString() == "int"
    assert not spark.catalog.tableExists("my_table")


def test_report_columns_and_single_reading(spark, both_plans):
    start = datetime(2024, 1, 1)
    data = [
        ("1", start + timedelta(seconds=1), 10.0),
        ("1", start + timedelta(seconds=299), 20.0),
        ("1", start + timedelta(seconds=300), 7.25),
        ("2", start, None),
        (None, start, 1.0),
    ]
    frame = spark.createDataFrame(data, "channel string, at timestamp_ntz, reading double")
    report = tumbling_report(frame, "channel", "at", "reading")
    assert report.columns == REPORT.fieldNames()
    five = timedelta(minutes=5)
    found = {(r.channel_id, r.window_start): tuple(r)[2:] for r in report.collect()}
    assert found == {
        ("1", start): (start + five, 1.0, 2, "10.0,20.0", 15.0, 20.0, 10.0, 7.1),
        ("1", start + five): (start + 2 * five, 1.0, 1, "7.25", 7.3, 7.3, 7.3, None),
        ("2", start): (start + five, 1.0, 0, None, None, None, None, None),
        (None, start): (start + five, 1.0, 1, "1.0", 1.0, 1.0, 1.0, None),
    }


def test_readings_follow_time_then_value(spark, both_plans):
    start = datetime(2024, 1, 1)
    data = [("1", start + timedelta(seconds=s), v) for s, v in [(9, 1.0), (3, 8.0), (3, 2.0), (5, 4.0)]]
    frame = spark.createDataFrame(data, "channel string, at timestamp_ntz, reading double")
    assert [r.readingsList for r in readings_list(frame, "channel", "at", "reading").collect()] == [
        "2.0,8.0,4.0,1.0"
    ]


def test_rounding_sheds_float_noise(spark):
    frame = spark.createDataFrame([(28.049999999999997,), (28.05,), (-28.05,)], "x double")
    assert [r.y for r in frame.select(stable_round(F.col("x")).alias("y")).collect()] == [28.1, 28.1, -28.1]


def test_sink_columns_match_by_position(spark):
    frame = spark.sql("SELECT 1 AS a, 2 AS b")
    with pytest.raises(ValueError):
        as_schema(frame, REPORT)


def test_amounts_that_are_no_numbers_give_no_alert(spark):
    amounts = ["1000.5", "NaN", "1000.5d", "1e9999", " 2e3 ", "inf", None, "x"]
    rows = [(str(i), a) for i, a in enumerate(amounts)]
    frame = spark.createDataFrame(rows, "transaction_id string, amount string")
    found = {r[0].split()[-1] for r in threshold_alerts(frame).collect()}
    assert found == {"0", "3", "4", "5"}


def test_extremes_are_rounded_once(spark):
    from tidegauge.operators.windows import tumbling_statistics

    frame = spark.sql("SELECT 'a' AS c, timestamp'2024-01-01 00:00:00' AS t, 10.0499999D AS v")
    row = tumbling_statistics(frame, "c", "t", "v").first()
    assert (row["maxReading"], row["minReading"]) == (10.0, 10.0)


def test_times_beyond_a_timestamp_are_null(spark):
    from tidegauge.functions.expressions import epoch_micros, instant

    frame = spark.createDataFrame([(2**63 - 1,), (-(2**63),), (60_000,)], "ms long")
    rows = frame.select(instant("ms").isNull(), epoch_micros("ms")).collect()
    assert [tuple(r) for r in rows] == [(True, None), (True, None), (False, 60_000_000)]


def test_word_counts_of_repeated_rows_nulls_and_no_rows(spark):
    frame = spark.createDataFrame([("a b a",), ("a b a",), (None,), ("",)], "t string")
    counted = transforms.word_counts(frame, "t", "word", "n", "documents")
    found = sorted(tuple(r) for r in counted.collect())
    assert found == [("", 1, 1), ("a", 4, 2), ("b", 2, 2)]
    assert transforms.word_counts(frame.where("false"), "t", "w", "n", "d").count() == 0
