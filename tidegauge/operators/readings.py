"""The ordered list of a window's readings, as text.

The list is the one part of the report that grows with its group.  Windows of
ordinary size gather it in the aggregate itself.  If the largest window is too
big for one task, the rows are range partitioned instead, each task joins the
readings of its slice, and only these pieces of text are put together.
"""

from __future__ import annotations

from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.expressions import interval_text
from tidegauge.plans.runs import RUN, sorted_runs
from tidegauge.plans.scans import Batches, key_changes

SEPARATOR = ","


def ordered_list(time: str, tie: str | None, value: str) -> Column:
    """Aggregate: non-NULL readings as text, by time and tie; NULL if there are none.

    The value itself decides between equal times and ties.
    """
    order = [F.col(time).alias("t"), F.col(tie or value).alias("o"), F.col(value).alias("v")]
    gathered = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(*order))))
    text = F.array_join(F.transform(gathered, lambda row: row["v"].cast("string")), SEPARATOR)
    return F.when(F.count(value) > 0, text)


def readings_parts(
    frame: DataFrame,
    channel: str,
    time: str,
    value: str,
    tie: str | None,
    size: timedelta,
    total: int,
) -> DataFrame:
    """The lists in pieces: (channel_id, window_start, window_end, run, part, readings).

    Sorted by (run, part) the pieces of a window make up its list.  They hold
    every reading, also where one text value could not.
    """
    rows = frame.where(F.col(value).isNotNull()).select(
        F.col(channel).cast("string").alias("channel_id"),
        F.window(time, interval_text(size)).alias("window"),
        F.col(time).alias("_time"),
        F.col(tie or value).alias("_tie"),
        F.col(value).alias("_value"),
        F.col(value).cast("string").alias("_text"),
    )
    rows = rows.select(
        "channel_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "_time",
        "_tie",
        "_value",
        "_text",
    )
    keys = ["channel_id", "window_start"]
    runs = sorted_runs(rows, keys, ["_time", "_tie", "_value"], total)
    group = ["channel_id", "window_start", "window_end", RUN]
    schema = T.StructType(
        [
            *[runs.schema[c] for c in group],
            T.StructField("part", T.LongType()),
            T.StructField("readings", T.StringType()),
        ]
    )

    def join_texts(batches: Batches) -> Batches:
        part = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            begins = np.flatnonzero(key_changes(batch, keys, None))
            begins = np.concatenate(([0], begins))
            offsets = np.append(begins, batch.num_rows).astype("int32")
            texts = pa.ListArray.from_arrays(pa.array(offsets), batch.column("_text"))
            numbers = np.arange(part, part + len(begins), dtype="int64")
            part += len(begins)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(pa.array(begins)) for c in group],
                    pa.array(numbers),
                    pc.binary_join(texts, SEPARATOR),
                ],
                names=schema.fieldNames(),
            )

    return runs.select(*group, "_text").mapInArrow(join_texts, schema).withColumnRenamed(RUN, "run")


def joined_parts(parts: DataFrame) -> DataFrame:
    """One list per (channel_id, window_start, window_end) out of its pieces."""
    pieces = F.array_sort(F.collect_list(F.struct("run", "part", "readings")))
    return parts.groupBy("channel_id", "window_start", "window_end").agg(
        F.array_join(F.transform(pieces, lambda p: p["readings"]), SEPARATOR).alias("readingsList")
    )
