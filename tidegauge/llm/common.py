"""Helpers that the operators share: batches of texts, ragged arrays, ordered buckets."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 500_000


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remembered(key: Hashable, make: Callable[[], Any], large: bool = False) -> Any:
    """What ``make`` gives, made once in a Python process for all its tasks.

    The package's functions travel with each task, and so do their globals; what is
    to outlive a task has to be kept outside of them. The last few things are kept, and
    of large ones the last: the operators of a chain share their Python processes.
    """
    kept = vars(sys).setdefault("_tidegauge_remembered", {})
    if key not in kept:
        if large:
            kept.pop(vars(sys).get("_tidegauge_large"), None)
            vars(sys)["_tidegauge_large"] = key
        while len(kept) >= 6:
            kept.pop(next(iter(kept)))
        kept[key] = make()
    return kept[key]


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a piece has about ``limit`` bytes of text, or one row.

    Behind the last piece, memory that Arrow holds in reserve goes back to the system:
    Python processes outlive their tasks.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False) + 64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    pa.default_memory_pool().release_unused()


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts of a batch; null is empty."""
    return [t or "" for t in batch.column(text).to_pylist()]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of many ranges [start, start + length), one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of consecutive groups of the given lengths (zero for an empty group)."""
    totals = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return totals[ends] - totals[ends - lengths]


def cut_points(frame: DataFrame, key: str, parts: int) -> list[int]:
    """At most ``parts - 1`` rising values that split ``key`` into ranges of like size."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    return sorted(set(frame.stat.approxQuantile(key, shares, 0.25 / parts)))


def bucket_of(key: Column, cuts: list[int]) -> Column:
    """Number of cut points at or below ``key``; nulls come after the last bucket."""
    if not cuts:
        return F.when(key.isNull(), F.lit(1)).otherwise(F.lit(0))

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < F.lit(cuts[middle]), tree(low, middle)).otherwise(
            tree(middle + 1, high)
        )

    return F.when(key.isNull(), F.lit(len(cuts) + 1)).otherwise(tree(0, len(cuts)))


def text_mark(text: Column) -> Column:
    """A number by which rows with an equal id, or without one, are told apart by their texts."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def learnable(key: Column) -> Column:
    """Whether a row may be learned from: crc32 of its id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def held_out(key: Column) -> Column:
    """Whether a row is kept for testing: that remainder is 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))
