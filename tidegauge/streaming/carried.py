"""Rules for streams whose rows wait in a table instead of one task's state.

Keyed state handles the waiting rows of one key in one task.  Here rows wait in a log
(``streaming.waiting``), and those whose time has come go through the batch operator,
which splits large keys.  One row per key is carried on to the next rows, as a table; it
is written when a slot of time closes, not with every micro-batch.  Windows and timers go
the same way, so that their results do not depend on the order of the rows either.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegauge.functions.expressions import epoch_micros, micros, same_key, sum_type
from tidegauge.operators.gaps import DEFAULT_GAP as LAG_GAP
from tidegauge.operators.gaps import with_previous
from tidegauge.operators.rolling import running_sum
from tidegauge.operators.throttle import DEFAULT_GAP as THROTTLE_GAP
from tidegauge.operators.throttle import throttle
from tidegauge.streaming.jobs import ORDER_LATENESS, REPORT_DELAY, TIMER_DELAY, TIMER_LATENESS
from tidegauge.streaming.waiting import Step, in_steps, results, slot_width

__all__ = [
    "gap_in_batches",
    "results",
    "running_sum_in_batches",
    "throttle_in_batches",
    "timed_sum_in_batches",
    "windows_in_batches",
]

_CARRIED = "_carried"


def _free_name(stream: DataFrame, name: str) -> str:
    """``name``, made longer until no column of the stream has it."""
    taken = {c.lower() for c in stream.columns}
    while name in taken:
        name += "_"
    return name


def _in_batches(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    held: str,
    kind: T.DataType,
    rule: Callable[[DataFrame], DataFrame],
    carry: Callable[[DataFrame, DataFrame], DataFrame],
    merge: Callable[[str], Column],
    folder: str,
    checkpoint: str,
    lateness: timedelta,
    **options,
) -> StreamingQuery:
    """Apply ``rule`` to the rows whose time has come and ``carry`` to them and the result.

    ``rule`` gets the rows with their key's carried value in the column ``held``.
    ``carry`` gives the rows' own (keys, held); ``merge`` aggregates a key's
    old and new value to the one that is carried on.
    """
    schema = T.StructType([*[stream.schema[k] for k in keys], T.StructField(held, kind)])

    def act(step: Step) -> None:
        due, carried = step.due(), step.table("carried", schema)
        same = same_key([due[k] for k in keys], [carried[k] for k in keys])
        known = due.join(carried, same, "left").select(due["*"], carried[held])
        written = step.give(rule(known))
        step.put(
            "carried",
            carried.unionByName(carry(due, written).select(*carried.columns))
            .groupBy(*keys)
            .agg(merge(held).cast(kind).alias(held)),
        )

    return in_steps(stream, time, folder, checkpoint, lateness, act, **options)


def windows_in_batches(
    stream: DataFrame,
    time: str,
    size: timedelta,
    windowed: Callable[[DataFrame], DataFrame],
    folder: str,
    checkpoint: str,
    lateness: timedelta = REPORT_DELAY,
    **options,
) -> StreamingQuery:
    """A batch operator on tumbling windows of ``size``, over windows that are closed.

    ``windowed`` gets all rows of the windows that close, and splits large ones as it does
    on a table; nothing but the log grows with a window.  A window is closed when the
    latest time is ``lateness`` and a slot behind it.
    """

    def act(step: Step) -> None:
        step.give(windowed(step.due()))

    width = slot_width(lateness, size)
    return in_steps(stream, time, folder, checkpoint, lateness, act, width, **options)


def timed_sum_in_batches(
    stream: DataFrame,
    key: str,
    time: str,
    value: str,
    folder: str,
    checkpoint: str,
    delay: timedelta = TIMER_DELAY,
    lateness: timedelta = TIMER_LATENESS,
    **options,
) -> StreamingQuery:
    """Every row sets a timer ``delay`` ahead; a timer gives (key, fired_at, total).

    Rows and timers stand on one line of time, in milliseconds: a timer reports its key's
    sum of all rows up to its own time.  Timers of one key and millisecond are one.
    Carried are each key's total and the timers that lie ahead, those of ``delay`` at most.
    Rows without a value set timers too.
    """
    ahead = micros(delay) // 1000
    summed = sum_type(stream.schema[value].dataType)
    key_field = T.StructField("key", stream.schema[key].dataType)
    totals = T.StructType([key_field, T.StructField(_CARRIED, summed)])
    timers = T.StructType([key_field, T.StructField("at", T.LongType())])
    own = stream.select(F.col(key).alias("key"), F.col(time).alias("time"), F.col(value).alias("value"))

    def act(step: Step) -> None:
        at = F.floor(epoch_micros("time") / 1000)
        due = step.due().select("key", at.alias("at"), F.col("value").cast(summed).alias("value"))
        set_timers = due.select("key", (F.col("at") + ahead).alias("at"))
        waiting = step.table("timers", timers).unionByName(set_timers).distinct()
        limit = (step.limit + 1) // 1000 - 1
        fires = waiting.where(F.col("at") <= limit)
        nothing = F.lit(None).cast(summed).alias("value")
        line = due.select("key", "at", F.lit(0).alias("fires"), "value").unionByName(
            fires.select("key", "at", F.lit(1).alias("fires"), nothing)
        )
        carried = step.table("carried", totals)
        line = running_sum(line, ["key"], ["at", "fires"], "value", "so_far").where("fires = 1")
        same = same_key([line["key"]], [carried["key"]])
        zero = F.lit(0).cast(summed)
        total = F.coalesce(carried[_CARRIED], zero) + F.coalesce(line["so_far"], zero)
        step.give(
            line.join(carried, same, "left").select(
                line["key"].alias(key), line["at"].alias("fired_at"), total.cast(summed).alias("total")
            )
        )
        step.put("timers", waiting.where(F.col("at") > limit))
        sums = due.groupBy("key").agg(F.sum("value").cast(summed).alias(_CARRIED))
        both = carried.unionByName(sums).groupBy("key")
        step.put("carried", both.agg(F.sum(_CARRIED).cast(summed).alias(_CARRIED)))

    return in_steps(own, "time", folder, checkpoint, lateness, act, **options)


def throttle_in_batches(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str],
    folder: str,
    checkpoint: str,
    gap: timedelta = THROTTLE_GAP,
    lateness: timedelta = ORDER_LATENESS,
    **options,
) -> StreamingQuery:
    """Keep each key's first row, then every row at least ``gap`` after the last kept one.

    Carried is the time of the last kept row.  Rows too close behind it go first;
    then the first row of a key is kept again.
    """

    held = _free_name(stream, _CARRIED)

    def rule(known: DataFrame) -> DataFrame:
        waited = epoch_micros(time) - epoch_micros(held) >= micros(gap)
        open_rows = known.where(F.col(held).isNull() | waited).drop(held)
        return throttle(open_rows, keys, time, tie, gap)

    def carry(batch: DataFrame, kept: DataFrame) -> DataFrame:
        return kept.groupBy(*keys).agg(F.max(time).alias(held))

    kind = stream.schema[time].dataType
    return _in_batches(
        stream, keys, time, held, kind, rule, carry, F.max, folder, checkpoint, lateness, **options
    )


def gap_in_batches(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str],
    folder: str,
    checkpoint: str,
    gap: timedelta = LAG_GAP,
    out: str = "last_recorded_timestamp",
    lateness: timedelta = ORDER_LATENESS,
    **options,
) -> StreamingQuery:
    """Keep rows at least ``gap`` after the key's row before, with its time as ``out``.

    Carried is the latest time of the key.
    """

    held = _free_name(stream, _CARRIED)

    def rule(known: DataFrame) -> DataFrame:
        lagged = with_previous(known, keys, [time, *tie], time, out)
        lagged = lagged.withColumn(out, F.coalesce(out, held)).drop(held)
        return lagged.where(epoch_micros(time) - epoch_micros(out) >= micros(gap))

    def carry(batch: DataFrame, kept: DataFrame) -> DataFrame:
        return batch.groupBy(*keys).agg(F.max(time).alias(held))

    kind = stream.schema[time].dataType
    return _in_batches(
        stream, keys, time, held, kind, rule, carry, F.max, folder, checkpoint, lateness, **options
    )


def running_sum_in_batches(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str],
    value: str,
    out: str,
    folder: str,
    checkpoint: str,
    lateness: timedelta = ORDER_LATENESS,
    **options,
) -> StreamingQuery:
    """Every row with its key's total so far, of the type that SUM has.

    Carried is the key's total.
    """
    kind = sum_type(stream.schema[value].dataType)
    nothing = F.lit(0).cast(kind)
    held, own = _free_name(stream, _CARRIED), _free_name(stream, "_sum")

    def rule(known: DataFrame) -> DataFrame:
        summed = running_sum(known, keys, [time, *tie], value, own)
        before = F.col(held)
        total = F.when(before.isNull(), F.col(own)).otherwise(
            before + F.coalesce(F.col(own).cast(kind), nothing)
        )
        return summed.withColumn(out, total.cast(kind)).drop(own, held)

    def carry(rows: DataFrame, summed: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum(value).cast(kind).alias(held))

    return _in_batches(
        stream, keys, time, held, kind, rule, carry, F.sum, folder, checkpoint, lateness, **options
    )
