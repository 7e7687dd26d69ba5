"""Functions over the rows of a key's window, with many partial results."""

from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators import processes

FIELDS = T.StructType([T.StructField("n", T.LongType()), T.StructField("longest", T.StringType())])


def functions():
    """Made here, so that they travel to the tasks with what they are."""

    def longest(texts):
        return max((t for t in texts if t is not None), key=lambda t: (len(t), t), default=None)

    def partial(rows):
        return {"n": rows.num_rows, "longest": longest(rows.column("text").to_pylist())}

    def merge(parts):
        parts = list(parts)
        return {"n": sum(p["n"] for p in parts), "longest": longest(p["longest"] for p in parts)}

    return partial, merge


@pytest.mark.parametrize("batch_rows", ["7", "10000"])
def test_one_window_holds_most_rows(spark, batch_rows):
    begin = datetime(2024, 5, 1)
    rows = [("hot", begin + timedelta(seconds=i % 60), "t" * (i % 13) + str(i)) for i in range(3000)]
    rows += [(None, begin + timedelta(minutes=i), None) for i in range(5)]
    rows += [("cold", None, "no time"), ("cold", begin, None)]
    frame = spark.createDataFrame(rows, "start string, at timestamp_ntz, text string").repartition(9)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        found = processes.process_windows(
            frame, "start", "at", timedelta(minutes=2), ["text"], *functions(), FIELDS
        ).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    expected = defaultdict(list)
    for key, at, text in rows:
        if at is not None:
            window = begin + (at - begin) // timedelta(minutes=2) * timedelta(minutes=2)
            expected[key, window].append(text)
    got = {(r["start"], r["window_start"]): (r["n"], r["longest"]) for r in found}
    assert got == {
        place: (len(texts), max((t for t in texts if t), key=lambda t: (len(t), t), default=None))
        for place, texts in expected.items()
    }
    assert all(r["window_end"] - r["window_start"] == timedelta(minutes=2) for r in found)


def test_no_rows(spark):
    frame = spark.createDataFrame([], "k int, at timestamp, text string")
    found = processes.process_windows(
        frame.withColumn("key", F.lit(1)), "k", "at", timedelta(1), ["text"], *functions(), FIELDS
    )
    assert found.columns == ["k", "window_start", "window_end", "n", "longest"] and found.count() == 0


def test_small_batches_come_together(spark):
    calls = T.StructType([T.StructField("calls", T.LongType()), T.StructField("n", T.LongType())])
    begin = datetime(2024, 5, 1)
    rows = [(i % 3, begin + timedelta(seconds=i), "t") for i in range(900)]
    frame = spark.createDataFrame(rows, "k int, at timestamp_ntz, text string").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")

    def partial(rows):
        return {"calls": 1, "n": rows.num_rows}

    def merge(parts):
        parts = list(parts)
        return {n: sum(p[n] for p in parts) for n in ("calls", "n")}

    try:
        found = processes.process_windows(
            frame, "k", "at", timedelta(1), ["text"], partial, merge, calls
        ).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((r["k"], r["calls"], r["n"]) for r in found) == [(k, 1, 300) for k in range(3)]
