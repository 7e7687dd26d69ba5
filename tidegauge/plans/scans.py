"""Arrow helpers that walk one task's sorted rows, a batch at a time.

Each scan holds one row and a few numbers between batches, so its memory does
not depend on how many rows a key has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

Batches = Iterator[pa.RecordBatch]

FIRST, LAST, SEGMENT = "_first", "_last", "_segment"


def key_changes(
    batch: pa.RecordBatch, keys: Sequence[str], before: pa.RecordBatch | None
) -> np.ndarray:
    """True where the key differs from the row before.

    ``before`` is the one-row batch ahead of this one.  Without it the first
    row is not marked.
    """
    changes = np.zeros(batch.num_rows, dtype=bool)
    for name in keys:
        column = batch.column(name)
        later, earlier = column.slice(1), column.slice(0, batch.num_rows - 1)
        changes[1:] |= _differs(later, earlier)
        if before is not None:
            changes[:1] |= _differs(column.slice(0, 1), before.column(name))
    return changes


def _differs(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Whether values differ; NULL equals NULL and NaN equals NaN, as in GROUP BY."""
    one_is_null = pc.xor(pc.is_null(left), pc.is_null(right))
    differs = pc.or_kleene(one_is_null, pc.not_equal(left, right))
    if pa.types.is_floating(left.type):
        differs = pc.and_not_kleene(differs, pc.and_kleene(pc.is_nan(left), pc.is_nan(right)))
    return pc.fill_null(differs, False).to_numpy(zero_copy_only=False)


def with_columns(batch: pa.RecordBatch, added: dict[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` and further columns behind its own."""
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *added.values()], names=[*batch.schema.names, *added]
    )


def with_end_mark(batches: Batches) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Non-empty batches, each with whether it is the task's last one."""
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if held is not None:
            yield held, False
        held = batch
    if held is not None:
        yield held, True


def edge_marks(rows: int, opens: bool, closes: bool) -> dict[str, pa.Array]:
    """Columns that mark a task's first row and its last row."""
    first, last = np.zeros(rows, dtype=bool), np.zeros(rows, dtype=bool)
    first[0], last[-1] = opens, closes
    return {FIRST: pa.array(first), LAST: pa.array(last)}


def previous_value_scan(keys: Sequence[str], column: str, out: str) -> Callable[[Batches], Batches]:
    """Add the value that ``column`` had one row earlier under the same key.

    It is NULL on a key's first row and on the task's first row.
    """

    def scan(batches: Batches) -> Batches:
        before = None
        for batch, closes in with_end_mark(batches):
            rows = batch.num_rows
            values = batch.column(column)
            changes = key_changes(batch, keys, before)
            changes[0] |= before is None
            ahead = values.slice(0, 1) if before is None else before.column(column)
            shifted = pa.concat_arrays([ahead, values.slice(0, rows - 1)])
            added = {out: pc.if_else(pa.array(changes), pa.scalar(None, values.type), shifted)}
            added.update(edge_marks(rows, before is None, closes))
            yield with_columns(batch, added)
            before = batch.slice(rows - 1, 1)

    return scan


def _running(
    values: pa.Array, segments: np.ndarray, continued: np.ndarray, before: Any
) -> pa.Array:
    """Running sums within segments; those ``continued`` start from ``before``.

    NaN stays in the sum, as in Spark; decimals are exact; whole numbers beyond
    64 bits are an error.
    """
    if pa.types.is_decimal(values.type):
        sums, total, own = [], before, None
        for value, part, goes_on in zip(values.to_pylist(), segments, continued, strict=True):
            total = value + (total if goes_on or part == own else 0)
            own = part
            sums.append(total)
        return pa.array(sums, values.type)
    numbers = values.to_numpy(zero_copy_only=False)
    running = pd.Series(numbers).groupby(segments, sort=False).cumsum(skipna=False).to_numpy()
    running = np.where(continued, running + running.dtype.type(before), running)
    if numbers.dtype.kind == "i":
        # Sums wrap around; where that shows in the end, floats are far off.
        rough = pd.Series(numbers.astype("float64")).groupby(segments, sort=False).cumsum()
        rough = np.where(continued, rough + float(before), rough)
        if np.any(np.abs(running.astype("float64") - rough) > 2.0**62):
            raise OverflowError("a running sum exceeds 64 bits")
    return pa.array(running)


def running_sum_scan(
    keys: Sequence[str],
    sums: dict[str, str],
    time: str | None = None,
    idle: int | None = None,
) -> Callable[[Batches], Batches]:
    """Add running sums (output name -> input column) and a segment number.

    A segment ends where the key changes and, with ``idle``, where ``time`` is
    more than ``idle`` after the row before.  Segment 0 is the one the task
    opens in, which may have begun in an earlier task.
    """

    def scan(batches: Batches) -> Batches:
        before, segment = None, 0
        totals = dict.fromkeys(sums, 0)
        for batch, closes in with_end_mark(batches):
            rows = batch.num_rows
            breaks = key_changes(batch, keys, before)
            if idle is not None:
                at = batch.column(time).to_numpy(zero_copy_only=False)
                last_at = at[0] if before is None else before.column(time)[0].as_py()
                # A missing time is NaN: no pause before or behind it.
                last_at = np.nan if last_at is None else last_at
                breaks |= np.diff(at, prepend=last_at) > idle
            segments = segment + np.cumsum(breaks)
            added = {}
            for out, source in sums.items():
                values = batch.column(source)
                added[out] = _running(values, segments, segments == segment, totals[out])
                totals[out] = added[out][-1].as_py()
            added[SEGMENT] = pa.array(segments.astype("int64"))
            added.update(edge_marks(rows, before is None, closes))
            yield with_columns(batch, added)
            segment = int(segments[-1])
            before = batch.slice(rows - 1, 1)

    return scan
