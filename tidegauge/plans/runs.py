"""Runs: time-ordered slices of a table, cut without regard to key limits.

A window function sends all rows of one key to one task.  Where a key is too
large for that, the table is range partitioned by (key, time, tie) instead: the
cuts then follow the data, so a key with a third of all rows becomes many
slices of ordinary size.  Each slice, a *run*, is scanned on its own.  What it
needs from earlier runs is a value that depends on their edges only, so it is
worked out on a table of one row per run and broadcast; that table is bounded
by the number of tasks, whatever the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.expressions import same_key, sum_type
from tidegauge.plans import buckets, scans
from tidegauge.plans.shared import stored
from tidegauge.plans.skew import rows_per_task

RUN, _SPREAD = "_run", "_spread"


def sorted_runs(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str], total: int
) -> DataFrame:
    """Cut ``frame`` into sorted runs and number them; the layout is not yet pinned.

    The row's own position is the last sort column, so that equal rows, however
    many, can be cut as well.
    """
    count = max(1, math.ceil(total / rows_per_task(frame.sparkSession)))
    by = [*keys, *order, _SPREAD]
    return (
        frame.withColumn(_SPREAD, F.monotonically_increasing_id())
        .repartitionByRange(count, *by)
        .sortWithinPartitions(*by)
        .drop(_SPREAD)
        .withColumn(RUN, F.spark_partition_id())
    )


def _extended(schema: T.StructType, fields: Sequence[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(name, kind) for name, kind in fields]])


_EDGE_FIELDS = [(scans.FIRST, T.BooleanType()), (scans.LAST, T.BooleanType())]


def _edges(scanned: DataFrame, first: Sequence[str], last: Sequence[str]) -> DataFrame:
    """One row per run: ``first`` of its first row and ``last`` of its last row."""
    return (
        scanned.where(F.col(scans.FIRST) | F.col(scans.LAST))
        .groupBy(RUN)
        .agg(
            F.max(F.when(F.col(scans.FIRST), F.struct(*first))).alias("first"),
            F.max(F.when(F.col(scans.LAST), F.struct(*last))).alias("last"),
        )
    )


def _previous_value(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, out: str, total: int
) -> DataFrame:
    runs = sorted_runs(frame, keys, order, total)
    schema = _extended(runs.schema, [(out, runs.schema[column].dataType), *_EDGE_FIELDS])
    scanned = stored(runs.mapInArrow(scans.previous_value_scan(keys, column, out), schema))

    # One row per run: an unpartitioned window is bounded by the task count.
    by_run = Window.orderBy(RUN)
    edges = _edges(scanned, [*keys, F.lit(0).alias("_")], [*keys, F.col(column).alias("_value")])
    before = F.lag("last").over(by_run)
    carries = edges.select(RUN, "first", before.alias("before")).select(
        RUN,
        F.when(
            F.col("before").isNotNull()
            & same_key([F.col("before")[k] for k in keys], [F.col("first")[k] for k in keys]),
            F.col("before")["_value"],
        ).alias("_carry"),
    )
    return (
        scanned.join(F.broadcast(carries), RUN)
        .withColumn(out, F.when(F.col(scans.FIRST), F.col("_carry")).otherwise(F.col(out)))
        .select(*frame.columns, out)
    )


def _running_sum(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    total: int,
    time: str | None = None,
    idle: int | None = None,
) -> DataFrame:
    kind = frame.schema[value].dataType
    wide = sum_type(kind)
    present = F.col(value).isNotNull()
    summed = frame.withColumn("_value", F.coalesce(F.col(value).cast(wide), F.lit(0).cast(wide)))
    summed = summed.withColumn("_present", present.cast("bigint"))
    runs = sorted_runs(summed, keys, order, total)
    sums = {"_sum": "_value", "_count": "_present"}
    schema = _extended(
        runs.schema,
        [
            ("_sum", wide),
            ("_count", T.LongType()),
            (scans.SEGMENT, T.LongType()),
            *_EDGE_FIELDS,
        ],
    )
    scan = scans.running_sum_scan(keys, sums, time, idle)
    scanned = stored(runs.mapInArrow(scan, schema))

    at = F.col(time) if time else F.lit(0)
    edges = _edges(
        scanned,
        [*keys, at.alias("_at")],
        [*keys, at.alias("_at"), scans.SEGMENT, "_sum", "_count"],
    )
    by_run = Window.orderBy(RUN)  # one row per run
    before, first = F.col("before"), F.col("first")
    goes_on = before.isNotNull() & same_key([before[k] for k in keys], [first[k] for k in keys])
    if idle is not None:
        # As in the window form, a missing time is no pause.
        goes_on = goes_on & F.coalesce(first["_at"] - before["_at"] <= idle, F.lit(True))
    # A run that is one single segment hands on what it received and its own
    # sum; any other hands on the sum of its last segment alone.
    chained = F.when(F.col("goes_on") & (before[scans.SEGMENT] == 0), 0).otherwise(1)
    linked = edges.select(RUN, "first", F.lag("last").over(by_run).alias("before"))
    linked = linked.withColumn("goes_on", goes_on)
    linked = linked.withColumn("chain", F.sum(chained).over(by_run))
    in_chain = Window.partitionBy("chain").orderBy(RUN)
    received = {c: F.when(F.col("goes_on"), before[c]).otherwise(F.lit(0)) for c in sums}
    carries = linked.select(
        RUN, *[F.sum(received[c]).over(in_chain).alias(f"{c}_in") for c in sums]
    )
    opening = F.col(scans.SEGMENT) == 0
    full = {c: F.col(c) + F.when(opening, F.col(f"{c}_in")).otherwise(F.lit(0)) for c in sums}
    return (
        scanned.join(F.broadcast(carries), RUN)
        .withColumn(out, F.when(full["_count"] > 0, full["_sum"]).cast(wide))
        .select(*frame.columns, out)
    )


class PlainNames(dict):
    """Where the names of a table went, whatever their case."""

    def __missing__(self, name: str) -> str:
        return next(p for n, p in self.items() if n.lower() == name.lower())


def plain(frame: DataFrame) -> tuple[DataFrame, PlainNames]:
    """``frame`` under names that no helper column has, and where each name went."""
    names = PlainNames((name, f"c{i}") for i, name in enumerate(frame.columns))
    return frame.toDF(*names.values()), names


def named(found: DataFrame, names: PlainNames, out: str) -> DataFrame:
    """The names again; ``out`` comes last and replaces a column of its name."""
    kept = [F.col(p).alias(name) for name, p in names.items() if name.lower() != out.lower()]
    return found.select(*kept, F.col("out").alias(out))


def previous_value(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    out: str,
    total: int | None = None,
) -> DataFrame:
    """lag(column) per key; with no keys, over the whole table.

    By buckets of time where these fit a task, else over split runs, for which rows are
    counted if their ``total`` is not given.
    """
    own, names = plain(frame)
    along = [names[k] for k in keys], [names[o] for o in order], names[column], "out"
    found = buckets.previous_value(own, *along)
    if found is None:
        found = _previous_value(own, *along, own.count() if total is None else total)
    return named(found, names, out)


def running_sum(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    total: int,
    time: str | None = None,
    idle: int | None = None,
) -> DataFrame:
    """Running sum per key, NULL until the first non-NULL value.

    By buckets of time where these fit a task, else over split runs.  With ``idle``
    the sum restarts where ``time`` is more than ``idle`` after the row before, always
    over split runs.  The type is that of SUM.
    """
    own, names = plain(frame)
    along = [names[k] for k in keys], [names[o] for o in order], names[value], "out"
    summed = buckets.running_sum(own, *along) if idle is None else None
    if summed is None:
        summed = _running_sum(own, *along, total, names[time] if time else None, idle)
    return named(summed, names, out)
