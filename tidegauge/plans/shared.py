"""The shared folder, and cutting lineage into it.

Copies outlive the query: remove the folder when its results are used, or set
``spark.cleaner.referenceTracking.cleanCheckpoints`` for the checkpoints.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
#: Narrow rows, such as ids and hashes, in a file or task of their own.
ROWS_PER_FILE = 100_000
#: Rows with whole texts that a task has at least, where there are as many.
TEXTS_PER_TASK = 2_500


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session without executors of its own (local mode) may fall back to a
    temporary folder; on a cluster a missing setting is an error.
    """
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def pinned(frame: DataFrame) -> DataFrame:
    """``frame`` checkpointed: its partitions and their row order stay as they are.

    The copy survives the loss of the executors that computed it.
    """
    context = frame.sparkSession.sparkContext
    folder = shared_folder(frame.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return frame.checkpoint(eager=True)


def files_for(rows: int) -> int:
    """Files in which so many narrow rows are well kept."""
    return 1 + rows // ROWS_PER_FILE


def in_fewer_tasks(texts: DataFrame, rows: int) -> DataFrame:
    """``texts`` of so many rows in tasks of ``TEXTS_PER_TASK`` or more; many rows stay as they are."""
    return texts.coalesce(1 + rows // TEXTS_PER_TASK)


def stored(frame: DataFrame, files: int | None = None) -> DataFrame:
    """``frame`` written as a table and read back.

    Later passes read only the columns they need, from compressed files, but in
    any order and with partitions of their own. With ``files``, narrow rows are written by
    at most so many tasks: every file costs more than its rows where the session has many
    partitions, and on local disks a process that sets its permissions.
    """
    folder = new_folder(frame.sparkSession, "stored")
    if files is not None:
        frame = frame.coalesce(files)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)
