"""Time buckets: the rows of large keys cut at multiples of one width of time.

A running sum or a lag needs one value from all earlier rows of its key.  Cut by
time, that value follows from one small row per (key, bucket), summed up before the
shuffle.  It is then put in front of its bucket as a row of its own, a *head*, so the
ordinary window function over (key, bucket) gives the result: the wide rows are
shuffled once, and neither sampled, joined nor copied.

The width is tried out on the narrow columns and made smaller until the largest
bucket fits a task.  Where no width does that (more rows of one instant than fit a
task, a first sort column that is no time or whole number, too many buckets), the
functions return None, and the caller cuts by all sort columns (``plans.runs``).

The rows are read twice, so ``frame`` must give the same rows each time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.expressions import epoch_micros, sum_type
from tidegauge.plans.shared import stored
from tidegauge.plans.skew import rows_per_task

_BUCKET, _OWN, _VALUE = "_bucket", "_own", "_value"
#: The first width: a day in microseconds.
_DAY = 86_400_000_000
_TRIALS = 4
#: So many buckets of one key are a small task, whatever the limit for rows.
_FEW = 100_000


@dataclass(frozen=True)
class Buckets:
    """How rows are cut, and one row per (key, bucket) with the measures asked for."""

    of: Column
    table: DataFrame


def _place(frame: DataFrame, time: str) -> Column | None:
    """``time`` as a whole number, if its order is that of one."""
    kind = frame.schema[time].dataType
    if isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType):
        return epoch_micros(time)
    return F.col(time).cast("bigint") if isinstance(kind, T.IntegralType) else None


def _cut(frame: DataFrame, keys: Sequence[str], time: str, measure: Column) -> Buckets | None:
    at = _place(frame, time)
    if at is None:
        return None
    limit = rows_per_task(frame.sparkSession)
    span = F.max(at).cast("double") - F.min(at).cast("double")
    full = F.col("_rows") > limit
    width = _DAY
    for _ in range(_TRIALS):
        # Rounding of large quotients is harmless: buckets keep the order of time.
        # Rows without a time sort first.
        of = F.coalesce(F.floor(at / F.lit(width)), F.lit(-(2**63)).cast("bigint"))
        table = stored(
            frame.groupBy(*keys, of.alias(_BUCKET)).agg(
                F.count(F.lit(1)).alias("_rows"),
                F.coalesce(span, F.lit(0.0)).alias("_span"),
                measure,
            )
        )
        found = (
            table.groupBy(*keys)
            .agg(
                F.count(F.lit(1)).alias("buckets"),
                F.min(F.when(full, F.col("_span"))).alias("span"),
                F.min(F.when(full, F.col("_span") / F.col("_rows"))).alias("step"),
            )
            .agg(F.max("buckets").alias("buckets"), F.min("span").alias("span"), F.min("step").alias("step"))
            .first()
        )
        if (found["buckets"] or 0) > max(limit, _FEW):
            return None
        if found["step"] is None:
            return Buckets(of, table)
        if found["span"] == 0 or width == 1:
            return None
        width = max(1, min(width // 2, int(found["step"] * limit / 2)))
    return None


def _with_heads(
    frame: DataFrame, of: Column, value: Column, heads: DataFrame
) -> DataFrame:
    """The rows with ``value`` and their bucket, and the heads, told apart by ``_own``."""
    rows = frame.select("*", of.alias(_BUCKET), value.alias(_VALUE), F.lit(1).alias(_OWN))
    return rows.unionByName(heads.withColumn(_OWN, F.lit(0)), allowMissingColumns=True)


def _along(keys: Sequence[str], order: Sequence[str]):
    """Within a bucket: the head, then the rows in order."""
    return Window.partitionBy(*keys, _BUCKET).orderBy(_OWN, *order)


def previous_value(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, out: str
) -> DataFrame | None:
    """lag(column) per key; ``frame`` has no column whose name starts with ``_``."""
    cut = _cut(frame, keys, order[0], F.max_by(column, F.struct(*order)).alias("_last"))
    if cut is None:
        return None
    # Per key one row per bucket, as checked.
    before = F.lag("_last").over(Window.partitionBy(*keys).orderBy(_BUCKET))
    heads = cut.table.select(*keys, _BUCKET, before.alias(_VALUE))
    both = _with_heads(frame, cut.of, F.col(column), heads)
    found = both.withColumn(out, F.lag(_VALUE).over(_along(keys, order)))
    return found.where(F.col(_OWN) == 1).select(*frame.columns, out)


def running_sum(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str
) -> DataFrame | None:
    """Running sum per key, NULL until the first value; names as in ``previous_value``."""
    wide = sum_type(frame.schema[value].dataType)
    # The sum of a bucket alone may leave a long where no running sum does.
    exact = T.DecimalType(38, 0) if isinstance(wide, T.LongType) else wide
    cut = _cut(frame, keys, order[0], F.sum(F.col(value).cast(exact)).alias("_total"))
    if cut is None:
        return None
    earlier = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    heads = cut.table.select(*keys, _BUCKET, F.sum("_total").over(earlier).cast(wide).alias(_VALUE))
    both = _with_heads(frame, cut.of, F.col(value).cast(wide), heads)
    so_far = _along(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn(out, F.sum(_VALUE).over(so_far).cast(wide))
    return found.where(F.col(_OWN) == 1).select(*frame.columns, out)
