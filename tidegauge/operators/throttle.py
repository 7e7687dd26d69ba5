"""Thinning a channel: after a kept row, drop rows until some time has passed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.expressions import epoch_micros, micros
from tidegauge.plans import chains, runs
from tidegauge.plans.scans import Batches
from tidegauge.plans.skew import by_weight

# Fixed value: the least distance between two kept rows of a channel.
DEFAULT_GAP = timedelta(seconds=240)


def throttle(
    frame: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str] = (),
    gap: timedelta = DEFAULT_GAP,
) -> DataFrame:
    """Keep each key's first row, then every row at least ``gap`` after the last kept one.

    Rows are taken in order of ``time``, then ``tie``; rows without a time are
    dropped.  The distance is elapsed time: a pause of one day and ten seconds
    counts as that, not as ten seconds.

    The rule is sequential within a key, so no window function expresses it.
    A key that fits one task is followed there in sorted order, with one row of
    memory; for keys that do not fit, see ``plans.chains``.
    """
    distance = micros(gap)
    if distance <= 0:
        raise ValueError("gap must be positive")
    # Under plain names, so that no column of the table is taken for a helper.
    own, names = runs.plain(frame)
    keys, time, tie = [names[k] for k in keys], names[time], [names[t] for t in tie]
    timed = own.where(F.col(time).isNotNull()).withColumn(chains.AT, epoch_micros(time))
    order = [chains.AT, *tie]

    def keep(batches: Batches) -> Batches:
        follower = chains.Follower(keys, distance)
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(follower.keep(batch)))

    def whole(rows: DataFrame) -> DataFrame:
        in_order = rows.repartition(*keys).sortWithinPartitions(*keys, *order)
        return in_order.mapInArrow(keep, timed.schema)

    def split(rows: DataFrame, total: int) -> DataFrame:
        return chains.throttled(rows, keys, order, distance, total)

    return by_weight(timed, keys, whole, split).select(*own.columns).toDF(*frame.columns)
