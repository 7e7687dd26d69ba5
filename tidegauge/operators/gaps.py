"""Filters on the distance in time to the row before."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.expressions import epoch_micros, micros
from tidegauge.plans import runs
from tidegauge.plans.skew import by_weight, columns_with

# Fixed value: the least distance between two rows.
DEFAULT_GAP = timedelta(milliseconds=60_000)


def with_previous(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, out: str
) -> DataFrame:
    """Add ``column`` of the row before, per key; an empty ``keys`` means the whole table.

    The whole-table form never uses one unpartitioned window: it always takes the
    split plan.
    """

    def whole(rows: DataFrame) -> DataFrame:
        along = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn(out, F.lag(column).over(along)).select(columns_with(rows, out))

    def split(rows: DataFrame, total: int | None = None) -> DataFrame:
        return runs.previous_value(rows, keys, order, column, out, total)

    if not keys:
        return split(frame)
    return by_weight(frame, keys, whole, split)


def gap_filter(
    frame: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str] = (),
    gap: timedelta = DEFAULT_GAP,
    out: str = "last_recorded_timestamp",
    keep_first: bool = False,
) -> DataFrame:
    """Keep rows at least ``gap`` after the row before, with that row's time as ``out``.

    A first row has no row before it and is dropped unless ``keep_first``.
    """
    lagged = with_previous(frame, keys, [time, *tie], time, out)
    far = epoch_micros(time) - epoch_micros(out) >= micros(gap)
    if keep_first:
        far = far | F.col(out).isNull()
    return lagged.where(far)
