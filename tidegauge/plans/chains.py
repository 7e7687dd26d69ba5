"""Following a keep-and-wait rule over split runs.

The rule keeps a row, then drops the key's rows until ``gap`` has passed.  What
happens in a run depends on the past through one number only, the time of the
last kept row (the *mark*).  So a run acts as a function from the mark it
receives to the mark it hands on, and that function is a staircase:

    a mark m is taken over by the first row at or after m + gap, and every such
    row leads to one fixed mark at the end of the run.

A run is *anchored* if it hands on the same mark whatever it receives: a new
key begins in it, or a pause of at least ``gap`` lies in it or before it.  Only
the runs between two anchors, all of one key, have to be chained.  Their
staircases are small tables of (reach, exit), and are followed in time order.
If a key has too many stairs for one task, neighbouring staircases are first
combined into one, in parallel and over several levels; the marks are then
handed down again level by level.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.expressions import same_key
from tidegauge.plans.runs import RUN, sorted_runs
from tidegauge.plans.scans import Batches, key_changes
from tidegauge.plans.shared import pinned, stored
from tidegauge.plans.skew import rows_per_task

#: Up to so many kept times are sent to all tasks.
_SENT_TIMES = 200_000

AT = "_at"  # event time in microseconds, never NULL


def kept(at: np.ndarray, starts: np.ndarray, gap: int, lead: int) -> tuple[np.ndarray, int]:
    """Which of these sorted rows are kept, and how long ago the last one was.

    ``starts`` marks the first row of a key and ``lead`` is the distance of
    row 0 from the last kept row.  Distances are cut at ``gap``, beyond which
    they no longer matter; so all keys lie on one line.  A row at least ``gap``
    behind the one before is kept whatever came earlier, and so opens a stretch;
    only stretches that are as long as ``gap`` have to be walked.
    """
    steps = np.minimum(np.diff(at, prepend=at[0]), gap)
    steps[starts] = gap
    steps[0] = lead
    place = np.cumsum(steps)
    mask = steps >= gap
    opens = np.flatnonzero(mask)
    ends = np.append(opens, len(at))
    long = place[ends[1:] - 1] - place[opens] >= gap
    walks = list(zip(np.searchsorted(place, place[opens[long]] + gap), ends[1:][long], strict=True))
    walks.append((np.searchsorted(place, gap), ends[0]))  # behind the last kept row so far
    for row, end in walks:
        if row < end:
            stretch = place[:end]
            following = np.searchsorted(stretch, stretch[row:] + gap).tolist()
            first, row = row, int(row)
            while row < end:
                mask[row] = True
                row = following[row - first]
    last = int(place[np.flatnonzero(mask)[-1]]) if mask.any() else 0
    return mask, min(gap, int(place[-1]) - last)


class Follower:
    """Applies the rule to sorted batches; holds one row and one distance."""

    def __init__(self, keys: Sequence[str], gap: int):
        self.keys, self.gap = keys, gap
        self.before: pa.RecordBatch | None = None
        self.since = 0

    def keep(self, batch: pa.RecordBatch, mark: int | None = None) -> np.ndarray:
        """Mask of kept rows; ``mark`` is the last kept time ahead of the first batch."""
        at = batch.column(AT).to_numpy(zero_copy_only=False)
        starts = key_changes(batch, self.keys, self.before)
        if self.before is not None:
            lead = self.since + int(at[0]) - self.before.column(AT)[0].as_py()
        else:
            lead = self.gap if mark is None else int(at[0]) - mark
        lead = self.gap if starts[0] else min(self.gap, lead)
        mask, self.since = kept(at, starts, self.gap, lead)
        self.before = batch.slice(batch.num_rows - 1, 1)
        return mask


def _last_of_path(following: np.ndarray) -> np.ndarray:
    """For each node, the last node on the path of ``following`` (len = no next)."""
    nodes = np.arange(len(following))
    path = np.where(following < len(following), following, nodes)
    while True:
        further = path[path]
        if np.array_equal(further, path):
            return path
        path = further


def staircase(
    reach: np.ndarray, exits: np.ndarray, gap: int, opens: int, entry: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Combine stairs in time order into one staircase, as (reach, exit).

    Rows are stairs whose reach and exit are their own time.  Marks come from
    before ``opens``, so only stairs up to the first one at ``opens + gap`` can
    be entered from outside; ``entry`` may exclude further ones.
    """
    path = _last_of_path(np.searchsorted(reach, exits + gap))
    enterable = np.arange(len(reach)) <= np.searchsorted(reach, opens + gap)
    if entry is not None:
        enterable &= entry
    reach, final = reach[enterable], exits[path][enterable]
    if len(reach) == 0:
        return reach, final
    rises = np.append(final[1:] != final[:-1], True)
    return reach[rises], final[rises]


def _run_edges(runs: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    """One row per run: its ends, widest step, and the mark it hands on if anchored."""
    key_fields = [runs.schema[k] for k in keys]
    schema = T.StructType(
        [
            T.StructField(RUN, T.IntegerType()),
            *[T.StructField(f"first_{f.name}", f.dataType) for f in key_fields],
            *[T.StructField(f"last_{f.name}", f.dataType) for f in key_fields],
            T.StructField("first_at", T.LongType()),
            T.StructField("last_at", T.LongType()),
            T.StructField("widest", T.LongType()),
            T.StructField("broken", T.BooleanType()),
            T.StructField("exit", T.LongType()),
        ]
    )

    def edges(batches: Batches) -> Batches:
        follower = Follower(keys, gap)
        head, widest, broken, last_kept = None, 0, False, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            before = follower.before
            at = batch.column(AT).to_numpy(zero_copy_only=False)
            steps = np.diff(at, prepend=at[0] if before is None else before.column(AT)[0].as_py())
            changes = key_changes(batch, keys, before)
            broken = broken or bool((changes | (steps >= gap)).any())
            widest = max(widest, int(np.where(changes, 0, steps).max()))
            mask = follower.keep(batch)
            if mask.any():
                last_kept = int(at[np.flatnonzero(mask)[-1]])
            head = batch.slice(0, 1) if head is None else head
        if head is not None:
            tail = follower.before
            yield pa.RecordBatch.from_arrays(
                [
                    head.column(RUN),
                    *[head.column(k) for k in keys],
                    *[tail.column(k) for k in keys],
                    head.column(AT),
                    tail.column(AT),
                    *[pa.array([v]) for v in (widest, broken, last_kept)],
                ],
                names=schema.fieldNames(),
            )

    return runs.select(RUN, *keys, AT).mapInArrow(edges, schema)


def _links(edges: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    """Chain the runs: which go on from the one before, and from which anchor.

    ``slack`` bounds how far a kept row of the run can lie behind a whole
    number of gaps after the anchor's mark: each step overshoots by less than
    the widest distance between neighbouring rows.
    """
    by_run = Window.orderBy(RUN)  # one row per run
    linked = edges.withColumn("before", F.lag(F.struct("*")).over(by_run))
    before = F.col("before")
    pause = F.col("first_at") - before["last_at"]
    goes_on = (
        before.isNotNull()
        & same_key([before[f"last_{k}"] for k in keys], [F.col(f"first_{k}") for k in keys])
        & (pause < gap)
    )
    linked = linked.withColumn("goes_on", goes_on)
    linked = linked.withColumn("anchored", ~F.col("goes_on") | F.col("broken"))
    linked = linked.withColumn("chain", F.sum(F.col("anchored").cast("bigint")).over(by_run))
    in_chain = Window.partitionBy("chain").orderBy(RUN)
    landings = F.floor((F.col("last_at") - F.col("first_at")) / gap) + 1
    overshoot = F.least(landings * F.greatest("widest", pause), F.lit(gap))
    added = F.when(F.col("anchored"), F.lit(0)).otherwise(overshoot)
    return linked.select(
        RUN,
        "goes_on",
        "anchored",
        "chain",
        "first_at",
        F.row_number().over(in_chain).cast("bigint").alias("link"),
        F.when(F.col("anchored"), F.col("exit")).alias("exit"),
        F.first("exit").over(in_chain).alias("anchor"),
        F.sum(added).over(in_chain).alias("slack"),
    )


_STAIRS = "chain bigint, link bigint, opens bigint, reach bigint, exit bigint"


def _run_stairs(runs: DataFrame, links: DataFrame, gap: int) -> DataFrame:
    """The staircase of every run that is not anchored; holds one run's times at once."""
    wanted = links.where(~F.col("anchored")).select(
        RUN, "chain", "link", "first_at", "anchor", "slack"
    )

    def stairs(batches: Batches) -> Batches:
        times, info = [], None
        for batch in batches:
            if batch.num_rows:
                times.append(batch.column(AT).to_numpy(zero_copy_only=False))
                info = batch.slice(0, 1).to_pylist()[0] if info is None else info
        if info is None:
            return
        at = np.concatenate(times)
        past = at - info["anchor"]
        reachable = (past >= gap) & (past % gap <= info["slack"])
        reach, exits = staircase(at, at, gap, info["first_at"], reachable)
        for start in range(0, len(reach), 100_000):
            part = slice(start, start + 100_000)
            size = len(reach[part])
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array(np.full(size, info[n])) for n in ("chain", "link", "first_at")],
                    pa.array(reach[part]),
                    pa.array(exits[part]),
                ],
                names=["chain", "link", "opens", "reach", "exit"],
            )

    # The broadcast side has one row per run.
    return runs.select(RUN, AT).join(F.broadcast(wanted), RUN).mapInArrow(stairs, _STAIRS)


def _combined(stairs: DataFrame, width: int, gap: int) -> DataFrame:
    """Staircases of ``width`` neighbouring links as one; a level up."""

    def combine(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["link", "reach"], kind="stable")
        opens = int(part["opens"].iloc[0])
        reach, exits = staircase(part["reach"].to_numpy(), part["exit"].to_numpy(), gap, opens)
        return pd.DataFrame(
            {
                "chain": part["chain"].iloc[0],
                "link": part["block"].iloc[0],
                "opens": opens,
                "reach": reach,
                "exit": exits,
            }
        )

    blocks = stairs.withColumn("block", F.floor(F.col("link") / width))
    return blocks.groupBy("chain", "block").applyInPandas(combine, _STAIRS)


def _walked(stairs: DataFrame, seeds: DataFrame, width: int, gap: int) -> DataFrame:
    """Follow the stairs of each (chain, block of links) from its seed mark.

    Gives the mark each link receives and hands on.  One task streams one
    block; it holds a single mark.
    """
    block = F.floor(F.col("link") / width).alias("block")
    rows = stairs.select("chain", block, "link", "reach", "exit")
    starts = seeds.select(
        "chain",
        "block",
        F.lit(-1).cast("bigint").alias("link"),
        F.lit(0).cast("bigint").alias("reach"),
        F.col("mark").alias("exit"),
    )

    def walk(batches: Batches) -> Batches:
        mark, entry, open_link, done = None, None, None, []
        moved = False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            chain, block, link, reach, exits = (
                c.to_numpy(zero_copy_only=False) for c in batch.columns
            )
            cuts = (np.diff(chain) != 0) | (np.diff(block) != 0) | (np.diff(link) != 0)
            begins = [0, *(np.flatnonzero(cuts) + 1).tolist(), batch.num_rows]
            for low, high in zip(begins[:-1], begins[1:], strict=True):
                name = (int(chain[low]), int(link[low]))
                if name[1] == -1:
                    if open_link:
                        done.append((*open_link, entry, mark))
                    open_link, mark = None, int(exits[low])
                    continue
                if name != open_link:
                    if open_link:
                        done.append((*open_link, entry, mark))
                    open_link, entry, moved = name, mark, False
                if not moved:
                    stair = low + int(np.searchsorted(reach[low:high], entry + gap))
                    if stair < high:
                        mark, moved = int(exits[stair]), True
            if done:
                yield pa.RecordBatch.from_pylist(done_rows(done), schema=out_schema)
                done = []
        if open_link:
            done.append((*open_link, entry, mark))
        if done:
            yield pa.RecordBatch.from_pylist(done_rows(done), schema=out_schema)

    out_schema = pa.schema([(n, pa.int64()) for n in ("chain", "link", "entry", "mark")])

    def done_rows(done):
        return [dict(zip(out_schema.names, values, strict=True)) for values in done]

    return (
        rows.unionByName(starts)
        .repartition("chain", "block")
        .sortWithinPartitions("chain", "block", "link", "reach")
        .mapInArrow(walk, "chain bigint, link bigint, entry bigint, mark bigint")
    )


_WHOLE_CHAIN = 1 << 62  # a block width that puts all links of a chain in one block


def _link_marks(stairs: DataFrame, anchors: DataFrame, gap: int) -> DataFrame:
    """The mark each chained run hands on."""
    budget = rows_per_task(stairs.sparkSession)
    levels, widths = [pinned(stairs)], []
    while True:
        top = levels[-1]
        per_link = top.groupBy("chain", "link").agg(F.count(F.lit(1)).alias("n"))
        per_chain = per_link.groupBy("chain").agg(
            F.sum("n").alias("n"), F.max("n").alias("widest"), F.count(F.lit(1)).alias("links")
        )
        reducible = F.when(F.col("links") > 1, F.col("n"))
        found = per_chain.agg(
            F.max(reducible).alias("n"), F.max("widest").alias("widest")
        ).first()
        if (found["n"] or 0) <= budget:
            break
        widths.append(max(2, budget // found["widest"]))
        levels.append(pinned(_combined(top, widths[-1], gap)))
    only_block = F.lit(0).cast("bigint").alias("block")
    seeds = anchors.select("chain", only_block, F.col("exit").alias("mark"))
    marks = _walked(levels[-1], seeds, _WHOLE_CHAIN, gap)
    for stairs_below, width in zip(reversed(levels[:-1]), reversed(widths), strict=True):
        seeds = marks.select("chain", F.col("link").alias("block"), F.col("entry").alias("mark"))
        marks = _walked(stairs_below, seeds, width, gap)
    return marks.select("chain", "link", "mark")


def _received_marks(links: DataFrame, marks: DataFrame) -> DataFrame:
    """One row per run: the mark it receives, NULL where it starts afresh."""
    by_run = Window.orderBy(RUN)  # one row per run
    earlier = Window.partitionBy("chain").orderBy(RUN)
    handed = links.join(marks, ["chain", "link"], "left").withColumn(
        "handed", F.last(F.coalesce("exit", "mark"), ignorenulls=True).over(earlier)
    )
    received = F.when(F.col("goes_on"), F.lag("handed").over(by_run))
    return handed.select(RUN, received.alias("_mark"))


def throttled(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str], gap: int, total: int
) -> DataFrame:
    """Rows of ``frame`` (with column ``_at``, first in ``order``) that the rule keeps.

    Of an instant the rule keeps one row at most, the first by the rest of ``order``. So
    it is followed on the distinct (key, time) alone, and the rows themselves are
    read and shuffled once: those of the kept times, if these are few enough to be sent
    to all tasks, else all, reduced to one per instant before the shuffle.
    """
    times = stored(_kept_times(frame.select(*keys, AT).distinct(), keys, gap, total))
    row, tie = F.struct(*frame.columns), F.struct(F.lit(0), *order[1:])
    few = times.count() <= _SENT_TIMES
    if few:
        sent = times.toDF(*[f"_{name}" for name in times.columns])
        same = same_key([frame[n] for n in times.columns], [sent[n] for n in sent.columns])
        frame = frame.join(F.broadcast(sent), same, "left_semi")
    rows = frame.select(*keys, AT, row.alias("_row"), tie.alias("_tie"), F.lit(few).alias("_kept"))
    if not few:
        # The marks have no tie, so their row is never the first.
        marks = times.withColumn("_kept", F.lit(True))
        rows = rows.unionByName(marks, allowMissingColumns=True)
    first = rows.groupBy(*keys, AT).agg(
        F.min_by("_row", "_tie").alias("_row"), F.max("_kept").alias("_kept")
    )
    return first.where("_kept").select("_row.*")


def _kept_times(times: DataFrame, keys: Sequence[str], gap: int, total: int) -> DataFrame:
    """The distinct times that the rule keeps per key, over split runs."""
    runs = pinned(sorted_runs(times, keys, [AT], total))
    links = pinned(_links(_run_edges(runs, keys, gap), keys, gap))
    stairs = _run_stairs(runs, links, gap)
    marks = _link_marks(stairs, links.where("anchored"), gap)
    received = pinned(_received_marks(links, marks))

    def keep(batches: Batches) -> Batches:
        follower = Follower(keys, gap)
        for batch in batches:
            if batch.num_rows:
                mark = batch.column("_mark")[0].as_py()
                yield batch.filter(pa.array(follower.keep(batch, mark)))

    marked = runs.join(F.broadcast(received), RUN)
    return marked.mapInArrow(keep, marked.schema).select(*times.columns)
