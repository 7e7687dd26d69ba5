"""Running sums along one channel's time line.

Each function sorts its rows by ``order`` within ``keys``.  ``order`` should be
total (time and a tie-break), since it decides which row gets which sum.

A channel that fits one task is summed by a window function.  For channels that do
not fit, the same result comes from split runs (``plans.runs``).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.expressions import epoch_micros, micros
from tidegauge.plans import runs
from tidegauge.plans.skew import by_weight, columns_with


def running_sum(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str
) -> DataFrame:
    """Every row gets its key's total so far, its own value included."""
    so_far = (
        Window.partitionBy(*keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return by_weight(
        frame,
        keys,
        lambda rows: rows.withColumn(out, F.sum(value).over(so_far)).select(columns_with(rows, out)),
        lambda rows, total: runs.running_sum(rows, keys, order, value, out, total),
    )


def delayed_running_sum(
    frame: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str],
    value: str,
    out: str,
    delay: timedelta,
) -> DataFrame:
    """Every row sets a timer ``delay`` after its time; the result is its key's
    total over all rows no later than that timer."""
    own, names = runs.plain(frame)
    summed = _delayed_running_sum(
        own,
        [names[k] for k in keys],
        names[time],
        [names[t] for t in tie],
        names[value],
        "out",
        micros(delay),
    )
    return runs.named(summed, names, out)


def _delayed_running_sum(
    frame: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str],
    value: str,
    out: str,
    ahead: int,
) -> DataFrame:
    timed = frame.withColumn("_at", epoch_micros(time))
    reach = Window.partitionBy(*keys).orderBy("_at").rangeBetween(Window.unboundedPreceding, ahead)
    # In runs, the timers join the rows' own time line: a row adds its value at its
    # time and reads the sum at its timer, behind all rows of that instant.
    adds = F.struct(F.col("_at").alias("at"), F.lit(0).alias("reads"), F.col(value).alias("adds"))
    reads = F.struct(
        (F.col("_at") + ahead).alias("at"),
        F.lit(1).alias("reads"),
        F.lit(None).cast(frame.schema[value].dataType).alias("adds"),
    )

    def split(rows: DataFrame, total: int) -> DataFrame:
        line = rows.withColumn("_step", F.explode(F.array(adds, reads))).select(
            *frame.columns,
            F.col("_step.at").alias("_at"),
            F.col("_step.reads").alias("_reads"),
            F.col("_step.adds").alias("_adds"),
        )
        order = ["_at", "_reads", *tie]
        summed = runs.running_sum(line, keys, order, "_adds", out, 2 * total)
        return summed.where("_reads = 1").select(columns_with(frame, out))

    return by_weight(
        timed,
        keys,
        lambda rows: rows.withColumn(out, F.sum(value).over(reach)).select(columns_with(frame, out)),
        split,
    )


def idle_reset_sum(
    frame: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str],
    value: str,
    out: str,
    idle: timedelta,
) -> DataFrame:
    """Running sum that starts again after a pause longer than ``idle``."""
    own, names = runs.plain(frame)
    summed = _idle_reset_sum(
        own,
        [names[k] for k in keys],
        names[time],
        [names[t] for t in tie],
        names[value],
        "out",
        micros(idle),
    )
    return runs.named(summed, names, out)


def _idle_reset_sum(
    frame: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str],
    value: str,
    out: str,
    limit: int,
) -> DataFrame:
    timed = frame.withColumn("_at", epoch_micros(time))
    order = ["_at", *tie]
    along = Window.partitionBy(*keys).orderBy(*order)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    restarts = (F.col("_at") - F.lag("_at").over(along) > limit).cast("int")
    in_part = (
        Window.partitionBy(*keys, "_part")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def whole(rows: DataFrame) -> DataFrame:
        parts = rows.withColumn("_restart", restarts)
        parts = parts.withColumn("_part", F.sum(F.coalesce("_restart", F.lit(0))).over(so_far))
        return parts.withColumn(out, F.sum(value).over(in_part)).select(columns_with(frame, out))

    def split(rows: DataFrame, total: int) -> DataFrame:
        summed = runs.running_sum(rows, keys, order, value, out, total, "_at", limit)
        return summed.select(columns_with(frame, out))

    return by_weight(timed, keys, whole, split)
