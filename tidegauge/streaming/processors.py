"""Per-key state for streams.

Rules that follow a key's rows in time hold the rows until the watermark has
passed them and then take them in event-time order, so that the result does not
depend on how rows are spread over micro-batches.  Rows travel and wait as
texts, which keep every type exact; state is in RocksDB.  A task handles the
waiting rows of one key at a time: those of the allowed lateness and of one
micro-batch.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

AT_MICROS = "at_us"  # event time in microseconds, added to every row
Rows = Iterator[pd.DataFrame]
Parse = Callable[[str], Any]


def sort_value(text: str | None, parse: Parse) -> tuple:
    """Where a value stands in Spark's ascending order: nulls first, NaN last."""
    if text is None:
        return (0,)
    value = parse(text)
    if isinstance(value, float) and math.isnan(value):
        return (2,)
    return (1, value)


class InTimeOrder(StatefulProcessor):
    """Hands a key's rows to ``follow`` in event-time order once the watermark has passed them.

    ``columns`` are the texts of a row; ``ties`` gives position and type of those
    that order rows of one instant.
    """

    added: Sequence[str] = ()

    def __init__(self, columns: Sequence[str], ties: Sequence[tuple[int, Parse]]):
        self.columns, self.ties = list(columns), list(ties)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = ", ".join(f"{c} string" for c in self.columns)
        self.waiting = handle.getListState("waiting", f"{AT_MICROS} bigint, {fields}")
        self.wakes = handle.getValueState("wakes", "at_ms bigint")

    def follow(self, rows: list[tuple]) -> list[tuple]:
        """The rows to give out; rows are (time, texts), results also have the added texts."""
        raise NotImplementedError

    def forgets_at(self, now: int) -> int | None:
        """When state without waiting rows may go; called again then, to let it go."""
        return None

    def ordered(self, rows: list[tuple]) -> list[tuple]:
        return sorted(
            rows, key=lambda r: (r[0], *[sort_value(r[1 + i], parse) for i, parse in self.ties])
        )

    def given(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[AT_MICROS, *self.columns, *self.added], dtype=object)

    def _wake(self, at: int) -> None:
        """Set the key's one timer to the millisecond at or behind ``at``, unless it is earlier."""
        wanted = -(-at // 1000)
        if self.wakes.exists():
            planned = self.wakes.get()[0]
            if planned <= wanted:
                return
            self.handle.deleteTimer(planned)
        self.handle.registerTimer(wanted)
        self.wakes.update((wanted,))

    def handleInputRows(self, key: Any, rows: Rows, timerValues: Any) -> Rows:
        earliest = []
        for batch in rows:
            taken = batch[[AT_MICROS, *self.columns]].itertuples(index=False, name=None)
            self.waiting.appendList(list(taken))
            earliest.append(int(batch[AT_MICROS].min()))
        self._wake(min(earliest))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Rows:
        self.wakes.clear()
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = [tuple(row) for row in self.waiting.get()] if self.waiting.exists() else []
        due, later = [r for r in held if r[0] <= now], [r for r in held if r[0] > now]
        given = self.follow(self.ordered(due)) if due else []
        if later and due:
            self.waiting.put(later)
        elif held and not later:
            self.waiting.clear()
        wake_at = min(r[0] for r in later) if later else self.forgets_at(now)
        if wake_at is not None:
            self._wake(wake_at)
        if given:
            yield self.given(given)

    def close(self) -> None:
        pass


class KeepAndWait(InTimeOrder):
    """Keeps a row, then drops the key's rows until ``gap`` microseconds have passed.

    The time of the last kept row is forgotten when no row can be too close to it.
    """

    def __init__(self, columns: Sequence[str], ties: Sequence[tuple[int, Parse]], gap: int):
        super().__init__(columns, ties)
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.mark = handle.getValueState("mark", "at bigint")

    def follow(self, rows: list[tuple]) -> list[tuple]:
        mark = self.mark.get()[0] if self.mark.exists() else None
        kept = []
        for row in rows:
            if mark is None or row[0] >= mark + self.gap:
                kept.append(row)
                mark = row[0]
        self.mark.update((mark,))
        return kept

    def forgets_at(self, now: int) -> int | None:
        if not self.mark.exists():
            return None
        free = self.mark.get()[0] + self.gap
        if free > now:
            return free
        self.mark.clear()
        return None


class PreviousTime(InTimeOrder):
    """Adds the time of the key's row before, in microseconds."""

    added = ("previous_us",)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "at bigint")

    def follow(self, rows: list[tuple]) -> list[tuple]:
        before = self.last.get()[0] if self.last.exists() else None
        times = [before, *[row[0] for row in rows]]
        self.last.update((times[-1],))
        return [
            (*row, None if at is None else str(at)) for row, at in zip(rows, times, strict=False)
        ]


class RunningSum(InTimeOrder):
    """Adds the key's total so far to every row, exact for whole numbers and decimals."""

    added = ("total_so_far",)

    def __init__(
        self,
        columns: Sequence[str],
        ties: Sequence[tuple[int, Parse]],
        value: tuple[int, Parse],
        ttl_ms: int | None = None,
    ):
        super().__init__(columns, ties)
        (self.at, self.parse), self.ttl_ms = value, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.total = handle.getValueState("total", "sum string", self.ttl_ms)

    def follow(self, rows: list[tuple]) -> list[tuple]:
        total = self.parse(self.total.get()[0]) if self.total.exists() else None
        summed = []
        for row in rows:
            if row[1 + self.at] is not None:
                value = self.parse(row[1 + self.at])
                total = value if total is None else total + value
            summed.append((*row, None if total is None else str(total)))
        if total is not None:
            self.total.update((str(total),))
        return summed


class IdleSum(RunningSum):
    """The running sum as rows come, forgotten when it was not written for ``ttl_ms``.

    The lifetime is by the wall clock, which needs processing-time mode; there is
    no watermark then, so rows are in event-time order within a micro-batch only.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "sum string", self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Rows, timerValues: Any) -> Rows:
        taken = [
            row
            for batch in rows
            for row in batch[[AT_MICROS, *self.columns]].itertuples(index=False, name=None)
        ]
        yield self.given(self.follow(self.ordered(taken)))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Rows:
        return iter(())


#: How the texts of these types are read; others are ordered as texts.
PARSERS: dict[str, Parse] = {"whole": int, "decimal": Decimal, "float": float, "text": str}


class TimedSum(StatefulProcessor):
    """Sums a key's values; every row sets a timer, and a timer reports the sum.

    Timers of the same key and millisecond are one timer.  All rows of a
    micro-batch are in the sum before its timers fire.

    The times to report at are kept as a list, and only the earliest is set as
    a timer of the engine: its expiry reports every time the watermark has
    passed and sets the next one.
    """

    def __init__(self, delay_ms: int):
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "sum double")
        self.waiting = handle.getListState("waiting", "fires_at bigint")

    def handleInputRows(self, key: Any, rows: Rows, timerValues: Any) -> Rows:
        total = self.total.get()[0] if self.total.exists() else 0.0
        times = np.empty(0, dtype="int64")
        for batch in rows:
            total += float(batch["value"].sum())
            times = np.union1d(times, batch["at_ms"].to_numpy(dtype="int64"))
        self.total.update((total,))
        fires = (times + self.delay_ms).tolist()
        self.waiting.appendList([(time,) for time in fires])
        self.handle.registerTimer(fires[0])
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Rows:
        passed = max(
            timerValues.getCurrentWatermarkInMs() - 1, expiredTimerInfo.getExpiryTimeInMs()
        )
        waiting = np.unique(np.array([row[0] for row in self.waiting.get()], dtype="int64"))
        due, later = waiting[waiting <= passed], waiting[waiting > passed]
        if len(due) == 0:
            return
        if len(later):
            self.waiting.put([(time,) for time in later.tolist()])
            self.handle.registerTimer(int(later[0]))
        else:
            self.waiting.clear()
        yield pd.DataFrame(
            {"key": key[0], "fired_at": due, "total": self.total.get()[0]}, index=range(len(due))
        )

    def close(self) -> None:
        pass
