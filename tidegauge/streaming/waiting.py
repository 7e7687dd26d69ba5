"""Rows of a stream that wait for their time, in a log that is written once.

Every micro-batch appends its own rows to a folder of its own, divided into slots of
time.  When the latest time seen is ``lateness`` behind a slot's end, the slot is closed:
its rows are read, from the folders of all micro-batches that have some, and handed on.
So a row is written once when it comes and read when its slot closes, however many
micro-batches it waits, and micro-batches are cut in the order of time, however the rows
came.  Rows of a slot that is closed already, or without a time, are left out.

A small record per micro-batch says which slots are closed, which folders hold open ones,
and under which number the tables that a rule carries on were last written.  A micro-batch
that is repeated after a failure reads the record of the one before it and overwrites its
own files; only micro-batches that the checkpoint has committed are read as results.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegauge.functions.expressions import epoch_micros, micros
from tidegauge.sinks.writers import stream_writer

_SLOT, _STEP = "slot", "step"
_ADAPTIVE = "spark.sql.adaptive.enabled"


@dataclass
class Record:
    """What a micro-batch leaves for the next one."""

    latest: int | None = None
    closed: int | None = None  # slots below this one
    open: list[list[int]] = field(default_factory=list)  # [micro-batch, first, last slot]
    tables: dict[str, int] = field(default_factory=dict)


class Step:
    """One micro-batch: the rows whose slots it closes, and the tables carried on."""

    def __init__(
        self,
        batch: DataFrame,
        number: int,
        folder: str,
        time: str,
        lateness: timedelta,
        width: int,
    ):
        self.spark, self.number, self.folder, self.schema = (
            batch.sparkSession, number, folder, batch.schema,
        )
        self.before = self._read_record()
        before, at = self.before, epoch_micros(time)
        slot = F.floor(at / F.lit(width))
        taken = batch.where(at.isNotNull() if before.closed is None else slot >= before.closed)
        plain = [f"c{i}" for i in range(len(batch.columns))]
        taken = taken.select(*[F.col(f"`{n}`") for n in batch.columns], slot.alias(_SLOT))
        own = self._place(number)
        taken.toDF(*plain, _SLOT).write.mode("overwrite").partitionBy(_SLOT).parquet(own)
        self._stored = T.StructType(
            [
                *[T.StructField(p, f.dataType) for p, f in zip(plain, batch.schema, strict=True)],
                T.StructField(_SLOT, T.LongType()),
            ]
        )
        timed = epoch_micros(plain[batch.columns.index(time)])
        found = (
            self.spark.read.schema(self._stored)
            .parquet(own)
            .agg(F.max(timed), F.min(_SLOT), F.max(_SLOT))
            .first()
        )
        seen = [t for t in (before.latest, found[0]) if t is not None]
        latest = max(seen, default=None)
        closed = before.closed
        if latest is not None:
            reached = (latest - micros(lateness)) // width
            closed = reached if closed is None else max(closed, reached)
        held = [*before.open, *([[number, found[1], found[2]]] if found[1] is not None else [])]
        self._due_from = [n for n, first, _ in held if closed is not None and first < closed]
        still = [
            [n, max(first, closed), last]
            for n, first, last in held
            if closed is None or last >= closed
        ]
        self.after = Record(latest, closed, still, dict(before.tables))
        #: The last instant, in microseconds, whose rows have all been handed on.
        self.limit = None if closed is None else closed * width - 1

    @property
    def has_due(self) -> bool:
        """Whether some waiting rows' time has come."""
        return bool(self._due_from)

    def due(self) -> DataFrame:
        """The rows whose slots this micro-batch closes, under their own names."""
        paths = [self._place(n) for n in self._due_from]
        stored = T.StructType([*self._stored, T.StructField(_STEP, T.LongType())])
        reader = self.spark.read.schema(stored).option("basePath", f"{self.folder}/waiting")
        rows = reader.parquet(*paths)
        rows = rows.where(F.col(_SLOT) < self.after.closed)
        if self.before.closed is not None:
            rows = rows.where(F.col(_SLOT) >= self.before.closed)
        return rows.drop(_SLOT, _STEP).toDF(*self.schema.names)

    def _place(self, number: int) -> str:
        """Where a micro-batch's own rows are, as a partition of the log."""
        return f"{self.folder}/waiting/{_STEP}={number}"

    def table(self, name: str, schema: T.StructType) -> DataFrame:
        """A carried table as the last micro-batch that wrote it left it."""
        written = self.before.tables.get(name)
        if written is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}/{written}")

    def put(self, name: str, frame: DataFrame) -> None:
        """Write a carried table for the micro-batches to come."""
        frame.write.mode("overwrite").parquet(f"{self.folder}/{name}/{self.number}")
        self.after.tables[name] = self.number

    def give(self, rows: DataFrame) -> DataFrame:
        """Write result rows; gives them as written."""
        here = f"{self.folder}/rows/{self.number}"
        rows.write.mode("overwrite").parquet(here)
        return self.spark.read.schema(rows.schema).parquet(here)

    def _read_record(self) -> Record:
        if self.number == 0:
            return Record()
        path = f"{self.folder}/records/{self.number - 1}"
        return Record(**json.loads(self.spark.read.text(path).first()[0]))

    def write_record(self) -> None:
        text = self.spark.createDataFrame([(json.dumps(asdict(self.after)),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{self.folder}/records/{self.number}")


def slot_width(lateness: timedelta, whole: timedelta | None = None) -> int:
    """Microseconds of a slot: a quarter of the lateness, in whole windows if there are any."""
    width = max(micros(lateness) // 4, 1_000_000)
    if whole is None:
        return width
    return -(-width // micros(whole)) * micros(whole)


def in_steps(
    stream: DataFrame,
    time: str,
    folder: str,
    checkpoint: str,
    lateness: timedelta,
    act: Callable[[Step], None],
    width: int | None = None,
    **options,
) -> StreamingQuery:
    """Start a query that calls ``act`` whenever the time of waiting rows has come."""
    width = width or slot_width(lateness)

    def run(batch: DataFrame, number: int) -> None:
        # A stream plans without runtime statistics; the work on one micro-batch
        # is a batch job and wants them, for large keys above all.
        spark = batch.sparkSession
        planned = spark.conf.get(_ADAPTIVE)
        spark.conf.set(_ADAPTIVE, "true")
        try:
            step = Step(batch, number, folder, time, lateness, width)
            if step.has_due:
                act(step)
            step.write_record()
        finally:
            spark.conf.set(_ADAPTIVE, planned)

    return stream_writer(stream, checkpoint, **options).foreachBatch(run).start()


def results(spark: SparkSession, folder: str, checkpoint: str, schema: T.StructType) -> DataFrame:
    """The result rows below ``folder`` of all micro-batches committed in ``checkpoint``."""

    def names(path: str) -> Sequence[str]:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        return [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []

    committed = {n for n in names(f"{checkpoint}/commits") if n.isdigit()}
    rows = [f"{folder}/rows/{n}" for n in names(f"{folder}/rows") if n in committed]
    if not rows:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*rows)
