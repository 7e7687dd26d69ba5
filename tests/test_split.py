"""The split plans against the keyed plans and against brute force."""

from datetime import timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegauge.functions.expressions import instant
from tidegauge.operators.gaps import gap_filter
from tidegauge.operators.rolling import delayed_running_sum, idle_reset_sum, running_sum
from tidegauge.operators.throttle import throttle
from tidegauge.operators.windows import readings_list, tumbling_report
from tidegauge.plans import chains
from tidegauge.plans.chains import kept, staircase

KEY, ORDER = ["event_type"], ["ts", "event_id"]


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


def summed(frame):
    return frame.select("event_id", F.round("out", 2).alias("out"))


OPERATORS = {
    "running_sum": lambda e: summed(running_sum(e, KEY, ORDER, "value", "out")),
    "delayed_sum": lambda e: summed(
        delayed_running_sum(e, KEY, "ts", ["event_id"], "value", "out", timedelta(hours=2))
    ),
    "idle_reset": lambda e: summed(
        idle_reset_sum(e, KEY, "ts", ["event_id"], "value", "out", timedelta(hours=3))
    ),
    "gap_filter": lambda e: gap_filter(e, KEY, "ts", ["event_id"], timedelta(hours=2)),
    "throttle_rare": lambda e: throttle(e, KEY, "ts", ["event_id"], timedelta(hours=1)),
    "throttle_often": lambda e: throttle(e, KEY, "ts", ["event_id"], timedelta(days=1)),
    "throttle_wide": lambda e: throttle(e, KEY, "ts", ["event_id"], timedelta(days=9)),
    "readings": lambda e: readings_list(e, "event_type", "ts", "value", "event_id", timedelta(days=7)),
    "report": lambda e: tumbling_report(e, "event_type", "ts", "value", "event_id", timedelta(days=7)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_split_equals_keyed(events, rows_per_task, name):
    expected = rows(OPERATORS[name](events))
    rows_per_task(90)
    assert rows(OPERATORS[name](events)) == expected


def test_one_key_with_equal_rows_is_cut(spark, rows_per_task):
    """A key with most rows, all at one instant and all alike, still has an exact sum."""
    frame = spark.range(600).select(
        F.when(F.col("id") < 500, "hot").otherwise("cold").alias("k"),
        F.lit(0).alias("t"),
        F.lit(1).cast("bigint").alias("v"),
    )
    rows_per_task(50)
    found = running_sum(frame, ["k"], ["t"], "v", "s")
    sums = {k: sorted(r.s for r in found.where(F.col("k") == k).collect()) for k in ("hot", "cold")}
    assert sums == {"hot": list(range(1, 501)), "cold": list(range(1, 101))}


def brute_force(times, gap):
    """Kept times by the definition."""
    found = []
    for t in sorted(times):
        if not found or t - found[-1] >= gap:
            found.append(t)
    return found


times_lists = st.lists(st.integers(0, 400), min_size=1, max_size=120)


@given(times_lists, st.integers(1, 150))
@settings(max_examples=200, deadline=None)
def test_kept_is_the_rule(times, gap):
    at = np.array(sorted(times), dtype="int64")
    mask, since = kept(at, np.zeros(len(at), dtype=bool), gap, gap)
    expected = brute_force(times, gap)
    assert at[mask].tolist() == expected
    assert since == min(gap, at[-1] - expected[-1])


@given(times_lists, st.integers(1, 150), st.integers(0, 200))
@settings(max_examples=200, deadline=None)
def test_staircase_gives_the_mark_handed_on(times, gap, lag):
    """For any mark from before the run, one look-up equals following the rule."""
    at = np.array(sorted(times), dtype="int64")
    mark = int(at[0]) - lag
    reach, exits = staircase(at, at, gap, int(at[0]))
    stair = int(np.searchsorted(reach, mark + gap))
    handed = int(exits[stair]) if stair < len(reach) else mark
    expected = mark
    for t in at.tolist():
        if t - expected >= gap:
            expected = t
    assert handed == expected


@given(times_lists, st.integers(1, 150), st.integers(0, 200), st.integers(1, 119))
@settings(max_examples=200, deadline=None)
def test_staircases_combine(times, gap, lag, cut):
    """The staircase of two neighbouring runs follows from theirs."""
    at = np.array(sorted(times), dtype="int64")
    parts = [p for p in (at[:cut], at[cut:]) if len(p)]
    stairs = [staircase(p, p, gap, int(p[0])) for p in parts]
    reach, exits = (np.concatenate([s[i] for s in stairs]) for i in (0, 1))
    reach, exits = staircase(reach, exits, gap, int(at[0]))
    mark = int(at[0]) - lag
    stair = int(np.searchsorted(reach, mark + gap))
    handed = int(exits[stair]) if stair < len(reach) else mark
    expected = mark
    for t in at.tolist():
        if t - expected >= gap:
            expected = t
    assert handed == expected


@pytest.mark.parametrize("gap", [7, 60, 900, 20_000], ids=str)
def test_split_throttle_on_uneven_times(spark, rows_per_task, gap):
    """Bursts, pauses and repeated times in one channel, cut into many runs."""
    random = np.random.default_rng(gap)
    steps = np.concatenate(
        [random.integers(0, 3, 700), random.integers(0, 60, 300), [5000], random.integers(0, 9, 500)]
    )
    random.shuffle(steps)
    times = np.cumsum(steps).tolist()
    data = [("hot", int(t), i) for i, t in enumerate(times)] + [("cold", 5, -1), ("cold", 500, -2)]
    frame = spark.createDataFrame(data, "c string, s bigint, id int")
    frame = frame.withColumn("at", instant(F.col("s") * 1000))
    rows_per_task(60)
    found = throttle(frame, ["c"], "at", ["id"], timedelta(seconds=gap))
    hot = sorted(r.s for r in found.where("c = 'hot'").collect())
    cold = sorted(r.s for r in found.where("c = 'cold'").collect())
    assert hot == brute_force(times, gap)
    assert cold == brute_force([5, 500], gap)


def test_throttle_keeps_its_promise(events):
    """Kept rows are far enough apart, dropped rows close behind a kept one."""
    gap = timedelta(hours=5)
    kept_ids = {r.event_id for r in throttle(events, ["user_id"], "ts", ["event_id"], gap).collect()}
    last = {}
    for row in sorted(events.collect(), key=lambda r: (r.ts, r.event_id)):
        before = last.get(row.user_id)
        if row.event_id in kept_ids:
            assert before is None or row.ts - before >= gap
            last[row.user_id] = row.ts
        else:
            assert row.ts - before < gap


def test_results_do_not_depend_on_row_order(events):
    shuffled = events.orderBy(F.rand(3))
    for name in ("running_sum", "throttle_rare", "readings"):
        assert rows(OPERATORS[name](shuffled)) == rows(OPERATORS[name](events))


ODD_VALUES = {
    "double": ["1", "1", "NaN", "1", None, "1", "1", "1"],
    "decimal(10,2)": ["0.10", "0.20", None, "0.30", "0.10", "0.20", "0.30", "0.10"],
    "bigint": [str(5 * 10**18 * (-1) ** i) for i in range(8)],
}


@pytest.mark.parametrize("kind", ODD_VALUES)
@pytest.mark.parametrize("rule", ["running", "idle"])
def test_split_sums_of_odd_values_equal_whole_ones(spark, rows_per_task, rule, kind):
    frame = spark.createDataFrame(
        [("a", i, None if i == 0 else i * 10 + 100 * (i > 5), v) for i, v in enumerate(ODD_VALUES[kind])],
        "k string, id int, s long, v string",
    )
    # Names that the split plan uses itself, and a missing time.
    frame = frame.select(
        "k", "id", instant(F.col("s") * 1000).alias("_at"), F.col("v").cast(kind).alias("_value"),
        F.lit(1).alias("_run"), F.lit("x").alias("_sum"),
    )

    def found():
        if rule == "running":
            return running_sum(frame, ["k"], ["_at", "id"], "_value", "out")
        return idle_reset_sum(
            frame.withColumnRenamed("_at", "at"), ["k"], "at", ["id"], "_value", "out",
            timedelta(seconds=50),
        )

    whole = found()
    expected = rows(whole)
    for limit in (1, 2, 3):
        rows_per_task(limit)
        split = found()
        assert split.schema["out"].dataType == whole.schema["out"].dataType
        assert str(rows(split)) == str(expected)


def test_split_sum_beyond_64_bits_is_an_error(spark, rows_per_task):
    frame = spark.range(4).select(F.lit(1).alias("k"), "id", F.lit(5 * 10**18).alias("v"))
    rows_per_task(3)
    with pytest.raises(Exception, match="64 bits|overflow"):
        running_sum(frame, ["k"], ["id"], "v", "out").collect()


MIXED = {
    "running": lambda f: running_sum(f, ["k"], ["at", "id"], "v", "v"),
    "delayed": lambda f: delayed_running_sum(f, ["k"], "at", ["id"], "v", "out", timedelta(seconds=5)),
    "idle": lambda f: idle_reset_sum(f, ["k"], "at", ["id"], "v", "out", timedelta(seconds=2)),
    "gaps": lambda f: gap_filter(f, ["k"], "at", ["id"], timedelta(seconds=2)),
    "throttle": lambda f: throttle(f, ["k"], "at", ["id"], timedelta(seconds=9)),
}


@pytest.fixture
def mixed(spark):
    """Two channels with most rows and many small ones, NaN and NULL among either."""
    channel = "IF(id < 200, double('NaN'), IF(id < 400, 1.0, IF(id < 430, NULL, floor(id / 10))))"
    return spark.range(600).selectExpr(
        f"{channel} AS k", "timestamp_millis(id * 37 % 601 * 1000) AS at", "id", "id % 7 AS v"
    )


@pytest.mark.parametrize("name", MIXED)
def test_only_large_keys_are_split(mixed, rows_per_task, name):
    whole = MIXED[name](mixed)
    expected = rows(whole)
    rows_per_task(60)
    found = MIXED[name](mixed)
    assert found.schema.fieldNames() == whole.schema.fieldNames()
    assert str(rows(found)) == str(expected)  # NaN among them
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan  # the small ones take the ordinary plan


def test_nan_is_one_channel_to_the_throttle(spark, rows_per_task):
    frame = spark.range(4).selectExpr("double('NaN') AS k", "timestamp_seconds(id) AS at", "id")
    for limit in (100, 2):
        rows_per_task(limit)
        kept_ids = [r.id for r in throttle(frame, ["k"], "at", ["id"], timedelta(hours=1)).collect()]
        assert kept_ids == [0]


def test_equal_ties_are_listed_alike(spark, rows_per_task):
    frame = spark.createDataFrame(
        [("a", 1, v) for v in (9.0, 3.0, 7.0, 1.0, 5.0, 2.0)], "k string, tie int, v double"
    ).withColumn("at", F.timestamp_seconds(F.lit(60)))
    lists = []
    for limit in (1000, 8):
        rows_per_task(limit)
        lists.append(rows(readings_list(frame, "k", "at", "v", "tie", timedelta(minutes=1))))
    assert lists[0] == lists[1]


@pytest.mark.parametrize("sent", [0, 200_000], ids=["marked", "sent"])
def test_split_throttle_reads_whole_rows_once(spark, rows_per_task, monkeypatch, sent):
    """One instant with most rows; equal ties, missing ties and wide rows come back whole."""
    frame = spark.range(700).selectExpr(
        "IF(id % 2 = 0, 'a', NULL) AS k",
        "timestamp_seconds(IF(id < 500, 50, id)) AS at",
        "IF(id = 4, NULL, 700 - id) AS tie",
        "map('id', id) AS _at",
        "array(id, id) AS _row",
        "-0.0D AS zero",
    )

    monkeypatch.setattr(chains, "_SENT_TIMES", sent)

    def found():
        thinned = throttle(frame, ["k", "zero"], "at", ["tie"], timedelta(seconds=30))
        assert thinned.columns == frame.columns
        return rows(thinned)

    expected = found()
    assert len(expected) > 10
    rows_per_task(40)
    assert str(found()) == str(expected)
    thinned = throttle(frame, ["k"], "at", ["tie"], timedelta(seconds=30))
    plan = thinned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 700") == 1  # the copies hold keys and times only
