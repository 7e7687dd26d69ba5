"""Size checks that choose between a keyed plan and a split plan, key by key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.expressions import same_key
from tidegauge.plans.shared import stored

ROWS_PER_TASK = "tidegauge.rowsPerTask"
_DEFAULT_ROWS_PER_TASK = 4_000_000
#: Up to so many large keys are sent to all tasks.
_SENT_KEYS = 10_000


@dataclass(frozen=True)
class GroupSizes:
    """Number of rows in a table, in its largest group, and in all groups over the limit."""

    total: int
    largest: int
    in_large: int


def rows_per_task(spark: SparkSession) -> int:
    """How many rows of one group a single task may be given."""
    return int(spark.conf.get(ROWS_PER_TASK, str(_DEFAULT_ROWS_PER_TASK)))


def group_sizes(frame: DataFrame, keys: Sequence) -> GroupSizes:
    """Count rows per group; reads the key columns only and combines map-side."""
    rows = F.count(F.lit(1)).alias("rows")
    limit = rows_per_task(frame.sparkSession)
    if not keys:
        total = frame.agg(rows).first()["rows"]
        return GroupSizes(total, total, total if total > limit else 0)
    found = (
        frame.groupBy(*keys)
        .agg(rows)
        .agg(
            F.sum("rows").alias("total"),
            F.max("rows").alias("largest"),
            F.sum(F.when(F.col("rows") > limit, F.col("rows"))).alias("in_large"),
        )
        .first()
    )
    return GroupSizes(found["total"] or 0, found["largest"] or 0, found["in_large"] or 0)


def columns_with(frame: DataFrame, out: str) -> list[str]:
    """The columns of ``frame`` with ``out`` last, once."""
    return [c for c in frame.columns if c != out] + [out]


def by_weight(
    frame: DataFrame,
    keys: Sequence[str],
    whole: Callable[[DataFrame], DataFrame],
    split: Callable[[DataFrame, int], DataFrame],
) -> DataFrame:
    """``whole`` for keys that fit a task; ``split`` for the rows of all others.

    ``split`` is also given their number.  Both give the same columns, in the same
    order.  Only the rows of large keys are laid out anew; of such keys there are
    at most as many as the table has rows for whole tasks.
    """
    limit = rows_per_task(frame.sparkSession)
    sizes = group_sizes(frame, keys)
    if sizes.largest <= limit:
        return whole(frame)
    if sizes.in_large == sizes.total:
        return split(frame, sizes.total)
    named = [F.col(k).alias(f"_large{i}") for i, k in enumerate(keys)]
    counts = frame.groupBy(*named).agg(F.count(F.lit(1)).alias("_rows"))
    large = stored(counts.where(F.col("_rows") > limit))
    own = F.broadcast(large) if large.count() <= _SENT_KEYS else large
    same = same_key([frame[k] for k in keys], [large[f"_large{i}"] for i in range(len(keys))])
    light, heavy = (frame.join(own, same, how) for how in ("left_anti", "left_semi"))
    return whole(light).union(split(heavy, sizes.in_large))
