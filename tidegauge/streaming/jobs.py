"""Streaming forms of the operators.

Windowed reports are built-in aggregates: rows are combined before the shuffle,
and a window leaves the state when the watermark has passed its end.  Rules
that depend on the row before use keyed state (see ``processors``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidegauge.functions.expressions import epoch_micros, interval_text, micros, sum_type
from tidegauge.operators.gaps import DEFAULT_GAP as LAG_GAP
from tidegauge.operators.throttle import DEFAULT_GAP as THROTTLE_GAP
from tidegauge.operators.windows import REPORT_WINDOW, tumbling_count, tumbling_report
from tidegauge.streaming.processors import (
    AT_MICROS,
    PARSERS,
    IdleSum,
    KeepAndWait,
    Parse,
    PreviousTime,
    RunningSum,
    TimedSum,
)

# Watermark delays, the timer, and the lifetime of an idle total.
REPORT_DELAY = timedelta(seconds=30)
TIMER_DELAY = timedelta(milliseconds=2000)
TIMER_LATENESS = timedelta(seconds=2)
TOTAL_TTL = timedelta(seconds=1)
# How late a row may come for rules that follow rows in time: as for reports.
ORDER_LATENESS = REPORT_DELAY

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, as keyed state requires."""
    before = spark.conf.get(_STATE_STORE, None)
    spark.conf.set(_STATE_STORE, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STATE_STORE)
        else:
            spark.conf.set(_STATE_STORE, before)


def watermarked(stream: DataFrame, time: str, delay: timedelta) -> DataFrame:
    """Declare ``time`` as event time; rows may come up to ``delay`` late."""
    zoned = stream.withColumn(time, F.col(time).cast("timestamp"))
    return zoned.withWatermark(time, interval_text(delay))


def report_stream(
    measurements: DataFrame, size: timedelta = REPORT_WINDOW, delay: timedelta = REPORT_DELAY
) -> DataFrame:
    """The window report of a measurement stream; a row appears once its window is closed."""
    timed = watermarked(measurements, "event_time", delay)
    return tumbling_report(timed, "channel_id", "event_time", "channel_value", size=size)


def count_stream(
    stream: DataFrame,
    key: str,
    time: str,
    size: timedelta = timedelta(milliseconds=5),
    delay: timedelta = timedelta(0),
) -> DataFrame:
    """Rows per key and window; without a delay, times are taken to be ascending."""
    return tumbling_count(watermarked(stream, time, delay), key, time, size)


def totals_stream(stream: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Current total per key, for update mode: one row per key and micro-batch.

    Partial sums are made before the shuffle, whatever the share of a key.
    """
    return stream.groupBy(key).agg(F.sum(value).alias(out))


def _parser(kind: T.DataType) -> Parse:
    if isinstance(kind, (T.IntegralType, T.TimestampType)):
        return PARSERS["whole"]
    if isinstance(kind, T.DecimalType):
        return PARSERS["decimal"]
    return PARSERS["float" if isinstance(kind, T.FractionalType) else "text"]


_NESTED = (T.ArrayType, T.MapType, T.StructType)


def _text(column: Column, kind: T.DataType) -> Column:
    """A value as text that gives the same value back (nested ones as far as JSON does)."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    return F.to_json(column) if isinstance(kind, _NESTED) else column.cast("string")


def _value(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(text.cast("bigint"))
    if isinstance(kind, T.BinaryType):
        return F.unhex(text)
    return F.from_json(text, kind) if isinstance(kind, _NESTED) else text.cast(kind)


def _in_state(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str],
    make_processor: Callable[..., StatefulProcessor],
    lateness: timedelta | None,
    added: Sequence[str] = (),
) -> DataFrame:
    """Run a processor over the rows of each key, with the rows' columns unchanged.

    Columns travel as texts under plain names (c0, c1, ...), since Spark drops
    names on the way to a processor that are no Python identifiers.  Rows
    without a time are left out.  Rows later than ``lateness`` are dropped and
    counted in the query's progress (numRowsDroppedByWatermark); so are rows up
    to 1970-01-01 00:00, where a watermark starts.  Without ``lateness`` there is no watermark, and the processor takes rows as they come.
    """
    names, kinds = stream.columns, [f.dataType for f in stream.schema.fields]
    plain = [f"c{i}" for i in range(len(names))]
    passed = stream.where(F.col(time).isNotNull()).select(
        *[F.col(f"`{k}`").alias(f"key{i}") for i, k in enumerate(keys)],
        *[_text(F.col(f"`{n}`"), k).alias(p) for n, k, p in zip(names, kinds, plain, strict=True)],
        epoch_micros(time).alias(AT_MICROS),
        F.col(time).cast("timestamp").alias("event_at"),
    )
    if lateness is not None:
        passed = passed.withWatermark("event_at", interval_text(lateness))
    ties = [(names.index(t), _parser(kinds[names.index(t)])) for t in tie]
    text = [T.StructField(c, T.StringType()) for c in (*plain, *added)]
    processed = passed.groupBy(*[f"key{i}" for i in range(len(keys))]).transformWithStateInPandas(
        statefulProcessor=make_processor(plain, ties),
        outputStructType=T.StructType([T.StructField(AT_MICROS, T.LongType()), *text]),
        outputMode="Append",
        timeMode="ProcessingTime" if lateness is None else "EventTime",
    )
    return processed.select(
        *[_value(F.col(p), k).alias(n) for n, k, p in zip(names, kinds, plain, strict=True)],
        *added,
    )


def throttle_stream(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str] = (),
    gap: timedelta = THROTTLE_GAP,
    lateness: timedelta = ORDER_LATENESS,
) -> DataFrame:
    """Keep each key's first row, then every row at least ``gap`` after the last kept one.

    A row is decided on when the watermark has passed it, in event-time order.
    """
    return _in_state(
        stream, keys, time, tie, lambda *rows: KeepAndWait(*rows, micros(gap)), lateness
    )


def gap_stream(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str] = (),
    gap: timedelta = LAG_GAP,
    out: str = "last_recorded_timestamp",
    lateness: timedelta = ORDER_LATENESS,
) -> DataFrame:
    """Keep rows at least ``gap`` after the key's row before, with its time as ``out``.

    A row is decided on when the watermark has passed it, in event-time order.
    """
    lagged = _in_state(stream, keys, time, tie, PreviousTime, lateness, PreviousTime.added)
    previous = lagged["previous_us"].cast("bigint")
    far = lagged.where(epoch_micros(time) - previous >= micros(gap))
    before = F.timestamp_micros(previous).cast(stream.schema[time].dataType)
    return far.select(*[far[c] for c in stream.columns], before.alias(out))


def running_sum_stream(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str],
    value: str,
    out: str,
    ttl: timedelta | None = None,
    lateness: timedelta = ORDER_LATENESS,
) -> DataFrame:
    """Every row with its key's total so far, of the type that SUM has.

    A row is summed when the watermark has passed it, in event-time order.  With
    ``ttl`` an idle total is forgotten after that much wall-clock time; rows are
    then summed as they come, as Spark has no such lifetime beside a watermark.
    Such a query must be given a time to run ``every``: the clock always leaves
    it something to do, so "what is there now" never ends.
    """
    kind = stream.schema[value].dataType
    summand = (stream.columns.index(value), _parser(kind))

    def processor(columns: list[str], ties: list) -> StatefulProcessor:
        if ttl is None:
            return RunningSum(columns, ties, summand)
        return IdleSum(columns, ties, summand, micros(ttl) // 1000)

    held = None if ttl is not None else lateness
    summed = _in_state(stream, keys, time, tie, processor, held, RunningSum.added)
    total = summed["total_so_far"].cast(sum_type(kind))
    return summed.select(*stream.columns, total.alias(out))


def timed_sum_stream(
    stream: DataFrame,
    key: str,
    time: str,
    value: str,
    delay: timedelta = TIMER_DELAY,
    lateness: timedelta = TIMER_LATENESS,
) -> DataFrame:
    """Every row sets an event-time timer; a timer gives (key, fired_at, total of the key)."""
    timed = watermarked(stream, time, lateness).select(
        F.col(key).alias("key"),
        time,
        F.unix_millis(time).alias("at_ms"),
        F.col(value).alias("value"),
    )
    fields = [
        T.StructField("key", stream.schema[key].dataType),
        T.StructField("fired_at", T.LongType()),
        T.StructField("total", T.DoubleType()),
    ]
    fired = timed.groupBy("key").transformWithStateInPandas(
        statefulProcessor=TimedSum(micros(delay) // 1000),
        outputStructType=T.StructType(fields),
        outputMode="Append",
        timeMode="EventTime",
    )
    return fired.withColumnRenamed("key", key)
