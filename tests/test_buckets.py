"""Sums and lags by time buckets against plain Python, and when runs take over."""

from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tidegauge.operators.gaps import with_previous
from tidegauge.operators.rolling import running_sum
from tidegauge.plans import buckets, runs

SECOND = 1_000_000

#: Times in seconds, in the order of rows.
TIMES = {
    "even": [i * 7 for i in range(300)],
    "burst": [i * 86_400 * 30 for i in range(40)] + [86_400 * 900 + i for i in range(260)],
    "before_epoch": [(i - 150) * 3600 for i in range(300)],
    "missing": [None] * 12 + [i * 60 for i in range(288)],
    "repeated": [i // 9 for i in range(300)],
    "wide_apart": [i * 86_400 * 200 for i in range(300)],
}


@pytest.fixture
def no_runs(monkeypatch):
    """Split runs are an error."""

    def refuse(*_, **__):
        raise AssertionError("cut into runs")

    monkeypatch.setattr(runs, "sorted_runs", refuse)


def table_of(spark, seconds, whole_numbers=False):
    """Two large channels and a missing one, rows shuffled; some values are missing."""
    data = [
        (key, t, i, None if i % 5 == 0 else i * 13 % 31 - 9)
        for key in ("a", "b", None)
        for i, t in enumerate(seconds)
    ]
    frame = spark.createDataFrame(data, "k string, s long, id int, v long")
    at = F.col("s") * 1000 if whole_numbers else F.timestamp_seconds("s")
    return frame.select("k", at.alias("at"), "id", "v").orderBy(F.hash("id", "k")), data


def in_order(data):
    """Rows per channel by time, those without one first, then by id."""
    by_time = sorted(data, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2]))
    return groupby(by_time, key=lambda r: r[0])


@pytest.mark.parametrize("whole_numbers", [False, True], ids=["timestamps", "numbers"])
@pytest.mark.parametrize("times", TIMES)
def test_sums_by_bucket(spark, rows_per_task, no_runs, times, whole_numbers):
    frame, data = table_of(spark, TIMES[times], whole_numbers)
    expected = {}
    for key, rows in in_order(data):
        total = None
        for _, _, i, v in rows:
            total = total if v is None else (total or 0) + v
            expected[key, i] = total
    rows_per_task(40)
    found = running_sum(frame, ["k"], ["at", "id"], "v", "out")
    assert {(r.k, r.id): r.out for r in found.collect()} == expected
    assert found.columns == ["k", "at", "id", "v", "out"]


@pytest.mark.parametrize("times", TIMES)
@pytest.mark.parametrize("keys", [["k"], []], ids=["keyed", "whole_table"])
def test_lags_by_bucket(spark, rows_per_task, no_runs, times, keys):
    frame, data = table_of(spark, TIMES[times])
    if not keys:
        frame, data = frame.where("k = 'a'"), [r for r in data if r[0] == "a"]
    expected = {}
    for key, rows in in_order(data):
        before = None
        for _, _, i, v in rows:
            expected[key, i] = before
            before = v
    rows_per_task(40)
    found = with_previous(frame, keys, ["at", "id"], "v", "out")
    assert {(r.k, r.id): r.out for r in found.collect()} == expected


def test_an_instant_too_large_for_a_task_is_cut_into_runs(spark, rows_per_task):
    frame = spark.range(300).selectExpr("'a' AS k", "timestamp_seconds(id div 100) AS at", "id")
    rows_per_task(40)
    plain, _ = runs.plain(frame)
    assert buckets.running_sum(plain, ["c0"], ["c1", "c2"], "c2", "out") is None
    found = running_sum(frame, ["k"], ["at", "id"], "id", "out").orderBy("id").collect()
    assert [r.out for r in found] == [i * (i + 1) // 2 for i in range(300)]


def test_text_as_time_is_cut_into_runs(spark, rows_per_task):
    frame = spark.range(300).selectExpr("'a' AS k", "format_string('%05d', id) AS at", "id")
    rows_per_task(40)
    found = with_previous(frame, ["k"], ["at"], "id", "out").orderBy("id").collect()
    assert [r.out for r in found] == [None, *range(299)]


def test_an_empty_table(spark):
    frame = spark.range(0).selectExpr("'a' AS k", "timestamp_seconds(id) AS at", "id")
    assert with_previous(frame, [], ["at", "id"], "id", "out").collect() == []


def test_rows_are_shuffled_once_and_not_copied(spark, events, rows_per_task):
    rows_per_task(60)
    found = running_sum(events, ["event_type"], ["ts", "event_id"], "value", "out")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "rangepartitioning" not in plan
    wide = [line for line in plan.splitlines() if "events.parquet" in line]
    assert len(wide) == 1
