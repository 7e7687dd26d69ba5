"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


_WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")
_MOST_MILLIS = (2**63 - 1) // 1000
#: What counts as a number in text: no type suffixes, but signs and exponents.
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def instant(epoch_ms: str | Column) -> Column:
    """Epoch milliseconds as a zoned timestamp; NULL beyond what a timestamp holds."""
    value = F.col(epoch_ms) if isinstance(epoch_ms, str) else epoch_ms
    return F.when(value.between(-_MOST_MILLIS, _MOST_MILLIS), F.timestamp_millis(value))


def epoch_micros(time: str | Column) -> Column:
    """Microseconds since the epoch.

    Whole numbers are epoch milliseconds; a zone-less timestamp is read in the
    session zone. The type is known when the query is planned, so one branch stays.
    """
    time = F.col(time) if isinstance(time, str) else time
    whole = F.typeof(time).isin(*_WHOLE_NUMBERS)
    millis = time.cast("string").try_cast("bigint")
    return F.when(whole, F.try_multiply(millis, F.lit(1000).cast("bigint"))).otherwise(
        F.unix_micros(time.cast("timestamp"))
    )


def micros(duration: timedelta) -> int:
    """Whole microseconds of a duration."""
    return duration // timedelta(microseconds=1)


def interval_text(duration: timedelta) -> str:
    """A duration in the form that window() and withWatermark() read."""
    return f"{micros(duration)} microseconds"


def stable_round(value: Column, digits: int = 1) -> Column:
    """Half-up rounding that first sheds float noise.

    The mean of 28.0 and 28.1 may come out as 28.049999... or 28.05, depending
    on the order in which partial sums were merged.  Rounding to six places
    first makes the tie visible, so that a result does not vary from run to run.
    """
    return F.round(F.round(value, 6), digits)


def readable_number(value: str | Column) -> Column:
    """Text as a double; NULL for text that is not a number. Numbers are taken as they are."""
    value = F.col(value) if isinstance(value, str) else value
    readable = (F.typeof(value) != "string") | value.cast("string").rlike(_NUMBER)
    return F.when(readable, value.try_cast("double"))


def same_key(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """NULL-safe equality of two key tuples; true for the empty key."""
    same = F.lit(True)
    for a, b in zip(left, right, strict=True):
        same = same & a.eqNullSafe(b)
    return same


def as_schema(frame, schema: T.StructType):
    """Match columns by position and cast each to the type the sink declares."""
    if len(frame.columns) != len(schema.fields):
        raise ValueError(
            f"the query has {len(frame.columns)} columns, the sink {len(schema.fields)}"
        )
    return frame.select(
        *[
            F.col(f"`{source}`").cast(field.dataType).alias(field.name)
            for source, field in zip(frame.columns, schema.fields, strict=True)
        ]
    )


def sum_type(kind: T.DataType) -> T.DataType:
    """The type of SUM over values of ``kind``."""
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(min(38, kind.precision + 10), kind.scale)
    return T.LongType() if isinstance(kind, T.IntegralType) else T.DoubleType()
