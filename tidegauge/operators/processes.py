"""Functions over the rows of a key's window."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegauge.functions.expressions import interval_text

#: From the rows of one key and window that came together to one value per field.
Partial = Callable[[pa.RecordBatch], dict]
#: From any number of partial results of one key and window to one of the same form.
Merge = Callable[[Iterator[dict]], dict]

#: Partial results of a window that are held before they are merged.
_PARTS = 64
#: Partial results of different windows that are made before they are passed on.
_HELD = 10_000
#: Rows, and bytes of them, that are grouped together.
_ROWS, _BYTES = 100_000, 16_000_000


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together up to so many rows or bytes; the last table may be smaller."""
    held, n_rows, n_bytes = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n_rows, n_bytes = n_rows + batch.num_rows, n_bytes + batch.nbytes
        if n_rows >= _ROWS or n_bytes >= _BYTES:
            yield pa.Table.from_batches(held)
            held, n_rows, n_bytes = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def process_windows(
    frame: DataFrame,
    key: str,
    time: str,
    size: timedelta,
    columns: list[str],
    partial: Partial,
    merge: Merge,
    fields: T.StructType,
) -> DataFrame:
    """One row per key and tumbling window: key, start, end, and what the functions give.

    ``partial`` gets Arrow batches with ``columns`` of one key and window, where the rows
    are, before anything is shuffled: those of some 100,000 rows of a task at a time.  Its
    results, rows of ``fields``, then meet by key and window and are merged as they come, so a
    window with a large share of the rows sends few rows and never lies whole in a task.
    ``merge`` gets an iterator, holds what it wants to of it, and must not depend on the order
    or grouping of its input.  Rows without a time are in no window; a null key is a key.
    """
    rows = frame.where(F.col(time).isNotNull()).select(
        F.col(key).alias("key"),
        F.window(time, interval_text(size)).alias("window"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)],
    )
    rows = rows.select(
        "key",
        F.unix_micros(F.col("window.start").cast("timestamp")).alias("start"),
        *[f"c{i}" for i in range(len(columns))],
    )
    kind = frame.schema[key].dataType
    parts = T.StructType(
        [T.StructField("key", kind), T.StructField("start", T.LongType()), *fields.fields]
    )
    names, kinds = fields.names, to_arrow_schema(fields).types

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _together(batches):
            places = pa.array(range(rows.num_rows), pa.int64())
            groups = rows.append_column("row", places).group_by(["key", "start"])
            groups = groups.aggregate([("row", "list")]).combine_chunks()
            lists = groups.column("row_list").combine_chunks()
            # Rows of a group side by side, so that each group is a view of them.
            near = rows.take(lists.flatten()).combine_chunks().to_batches()[0]
            near = pa.RecordBatch.from_arrays(near.columns[2:], names=columns)
            edges = lists.offsets.to_pylist()
            for begin in range(0, len(lists), _HELD):
                end = min(begin + _HELD, len(lists))
                found = [
                    partial(near.slice(a, b - a))
                    for a, b in zip(edges[begin:end], edges[begin + 1 : end + 1], strict=True)
                ]
                arrow = [groups.column(c).chunk(0)[begin:end] for c in ("key", "start")]
                arrow += [
                    pa.array([row[n] for row in found], kind)
                    for n, kind in zip(names, kinds, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrow, names=["key", "start", *names])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of a key and window stand next to each other; partial results so far are
        # merged as they come, so that few are held.
        at, held = None, []
        for batch in batches:
            places, done = [], []
            columns = [c.to_pylist() for c in batch.columns]
            for key, start, *values in zip(*columns, strict=True):
                if held and at != (key, start):
                    places.append(at)
                    done.append(merge(iter(held)))
                    held = []
                at = key, start
                held.append(dict(zip(names, values, strict=True)))
                if len(held) >= _PARTS:
                    held = [merge(iter(held))]
            if done:
                yield results(batch.schema, places, done)
        if held:
            yield results(batch.schema, [at], [merge(iter(held))])

    def results(schema: pa.Schema, places: list[tuple], done: list[dict]) -> pa.RecordBatch:
        values = [*zip(*places, strict=True), *([row[n] for row in done] for n in names)]
        arrow = [pa.array(v, k) for v, k in zip(values, schema.types, strict=True)]
        return pa.RecordBatch.from_arrays(arrow, schema=schema)

    found = rows.mapInArrow(first, parts)
    whole = found.repartition("key", "start").sortWithinPartitions("key", "start")
    whole = whole.mapInArrow(merged, parts)
    begin = F.timestamp_micros("start").cast(frame.schema[time].dataType)
    return whole.select(
        F.col("key").alias(key),
        begin.alias("window_start"),
        (begin + size).alias("window_end"),
        *names,
    )
