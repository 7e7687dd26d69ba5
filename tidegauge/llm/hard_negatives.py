"""Hard negatives by best-first search in STR-packed R-trees.

Vectors are tiled over shards by label and leading coordinates, and packed in each shard
into an R-tree: sort-tile-recursive leaves of one label's rows, then boxes around
neighbouring boxes.  A box gives, per coordinate, the interval that ``query * x`` can
take in it; their sum bounds the inner product from both sides.

A search keeps its boxes in a queue, largest upper bound first.  A box is left out where
its labels do not suit, where its interval lies outside the score window, or where its
upper bound is strictly below the k-th best score found; equal bounds are opened, as a
tie may have the smaller id.  Positives are one search over rows of the anchor's label.
Negatives are one search for all score windows of an anchor; a box is opened while any of
its windows may still gain from it.

Shards are sent once to every group of query blocks, rows of queries in full blocks; the
best of all shards are merged by a window per anchor over at most k rows of each shard.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import shuffle_partitions
from tidegauge.plans.shared import stored

SHARD_ROWS = 4096
QUERY_ROWS = 512
#: Blocks of queries that one copy of a shard meets.
GROUP_BLOCKS = 16
_LEAF = 64
_FAN = 16
_TILED = 3
#: Sums below this are exact in floating point too, which multiplies faster.
_EXACT = 2**53


def _tiled(rows: np.ndarray, weights: np.ndarray, dims: list[int]) -> np.ndarray:
    """Rows in sort-tile-recursive order over some coordinates."""
    if not dims or len(rows) <= _LEAF:
        return rows
    rows = rows[np.argsort(weights[rows, dims[0]], kind="stable")]
    leaves = math.ceil(len(rows) / _LEAF)
    slabs = math.ceil(leaves ** (1 / len(dims)))
    step = math.ceil(leaves / slabs) * _LEAF
    return np.concatenate(
        [_tiled(rows[i : i + step], weights, dims[1:]) for i in range(0, len(rows), step)]
    )


class Tree:
    """An R-tree over the rows of one shard; labels are one more side of its boxes."""

    def __init__(self, keys: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        spread = weights.astype(np.float64).var(axis=0) if len(keys) else np.zeros(0)
        dims = np.argsort(-spread, kind="stable")[:_TILED].tolist()
        parts, starts, filled = [], [], 0
        for label in np.unique(labels):
            rows = _tiled(np.flatnonzero(labels == label), weights, dims)
            parts.append(rows)
            starts.extend(range(filled, filled + len(rows), _LEAF))
            filled += len(rows)
        order = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.keys, self.labels, self.weights = keys[order], labels[order], weights[order]
        self.floats = self.weights.astype(np.float64)
        self.largest = int(np.abs(weights).max()) if weights.size else 0
        self.starts = np.array([*starts, filled])
        #: From the leaves up: boxes as (low, high, least label, greatest label).
        self.levels = []
        if len(starts):
            at = self.starts[:-1]
            box = (
                np.minimum.reduceat(self.weights, at),
                np.maximum.reduceat(self.weights, at),
                np.minimum.reduceat(self.labels, at),
                np.maximum.reduceat(self.labels, at),
            )
            self.levels.append(box)
            while len(box[0]) > _FAN:
                at = np.arange(0, len(box[0]), _FAN)
                box = (
                    np.minimum.reduceat(box[0], at),
                    np.maximum.reduceat(box[1], at),
                    np.minimum.reduceat(box[2], at),
                    np.maximum.reduceat(box[3], at),
                )
                self.levels.append(box)

    def _bounds(self, level: int, boxes: slice, query: np.ndarray) -> tuple[np.ndarray, ...]:
        """Least and greatest inner product of a query in some boxes of a level."""
        low, high, *labels = (side[boxes] for side in self.levels[level])
        up, down = np.maximum(query, 0), np.minimum(query, 0)
        return low @ up + high @ down, high @ up + low @ down, *labels

    def _scores(self, rows: slice, query: np.ndarray, exact: bool) -> np.ndarray:
        if exact:
            return (self.floats[rows] @ query.astype(np.float64)).astype(np.int64)
        return self.weights[rows] @ query

    def search(
        self,
        key: int,
        label: int,
        query: np.ndarray,
        same: bool,
        windows: list[tuple[int | None, int | None]],
        k: int,
    ) -> list[list[tuple[int, int]]]:
        """Per window (least, greatest score): the best ``k`` as (score, key), best first.

        Rows are those of the query's label (``same``) or of all others, without rows of
        the query's own key.  A bound of None is open.
        """
        # Heaps of (score, -key): the worst kept row is on top.
        best: list[list[tuple[int, int]]] = [[] for _ in windows]
        exact = self.largest * int(np.abs(query).sum()) < _EXACT
        queue: list[tuple[int, int, int, int]] = []

        def gains(low: int, high: int) -> bool:
            for (least, greatest), kept in zip(windows, best, strict=True):
                if (least is None or high >= least) and (greatest is None or low <= greatest):
                    reach = high if greatest is None else min(high, greatest)
                    if len(kept) < k or reach >= kept[0][0]:
                        return True
            return False

        def push(level: int, boxes: slice) -> None:
            lows, highs, least, greatest = self._bounds(level, boxes, query)
            if same:
                suits = (least <= label) & (greatest >= label)
            else:
                suits = (least != label) | (greatest != label)
            for i in np.flatnonzero(suits).tolist():
                low, high = int(lows[i]), int(highs[i])
                if gains(low, high):
                    heapq.heappush(queue, (-high, level, boxes.start + i, low))

        if self.levels and windows and k > 0:
            push(len(self.levels) - 1, slice(0, len(self.levels[-1][0])))
        while queue:
            high, level, box, low = heapq.heappop(queue)
            if not gains(low, -high):
                continue
            if level:
                last = min((box + 1) * _FAN, len(self.levels[level - 1][0]))
                push(level - 1, slice(box * _FAN, last))
                continue
            rows = slice(int(self.starts[box]), int(self.starts[box + 1]))
            scores, keys = self._scores(rows, query, exact), self.keys[rows]
            takes = (self.labels[rows] == label) == same
            takes &= keys != key
            for (least, greatest), kept in zip(windows, best, strict=True):
                fits = takes
                if least is not None:
                    fits = fits & (scores >= least)
                if greatest is not None:
                    fits = fits & (scores <= greatest)
                if len(kept) == k:
                    fits = fits & (scores >= kept[0][0])
                for pair in zip(scores[fits].tolist(), (-keys[fits]).tolist(), strict=True):
                    if len(kept) < k:
                        heapq.heappush(kept, pair)
                    elif pair > kept[0]:
                        heapq.heapreplace(kept, pair)
        return [[(s, -n) for s, n in sorted(kept, reverse=True)] for kept in best]


def _quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) per component; null if a component is null or not finite."""
    good = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return F.when(F.coalesce(good, F.lit(False)), whole)


_BLOCK = "dims int, n int, keys binary, labels binary, weights binary, windows binary"


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (key, label, dims, weights[, windows]) as blocks of at most ``size`` rows."""
    has_windows = "windows" in rows.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple]] = {}

        def block(dims: int) -> pa.RecordBatch:
            taken = waiting.pop(dims)
            keys, labels, weights, windows = zip(*taken, strict=True)
            # Windows as (row, least, greatest).
            edges = [(i, *pair) for i, pairs in enumerate(windows) for pair in pairs]
            cells = [
                np.array(keys, "<i8").tobytes(),
                np.array(labels, "<i8").tobytes(),
                np.array(weights, "<i8").tobytes(),
                np.array(edges, "<i8").tobytes(),
            ]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([dims], pa.int32()),
                    pa.array([len(taken)], pa.int32()),
                    *[pa.array([c], pa.binary()) for c in cells],
                ],
                names=["dims", "n", "keys", "labels", "weights", "windows"],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "label", "dims", "weights")]
            windows = [[]] * batch.num_rows
            if has_windows:
                listed = batch.column("windows").to_pylist()
                windows = [[(w["least"], w["greatest"]) for w in row] for row in listed]
            for key, label, dims, weights, own in zip(*columns, windows, strict=True):
                waiting.setdefault(dims, []).append((key, label, weights, own))
                if len(waiting[dims]) == size:
                    yield block(dims)
        for dims in list(waiting):
            yield block(dims)

    names = ["key", "label", "dims", "weights", *(["windows"] if has_windows else [])]
    return rows.select(*names).mapInArrow(pack, _BLOCK)


def _full_blocks(rows: DataFrame, size: int) -> DataFrame:
    """The same, from rows spread evenly over as many tasks as there are full blocks."""
    count = rows.count()
    parts = max(1, math.ceil(count / size))
    return _blocks(rows.repartition(parts), size)


def _searched(shards: DataFrame, queries: DataFrame, same: bool, k: int) -> DataFrame:
    """Best rows of every shard for every query: anchor_id, anchor, window, key, score.

    ``window`` is the greatest score of the window; without windows it is null and the
    window is open.  Shards and blocks of queries that meet are put next to each other by
    one exchange, a copy of the shard first; a task holds one shard and one block.
    """
    spark = shards.sparkSession
    numbers = shards.select("dims", "number")
    grouped = queries.withColumn("block", F.monotonically_increasing_id())
    # Block numbers are dense enough within a partition; the hash spreads the groups.
    groups = math.ceil(max(1, grouped.count()) / GROUP_BLOCKS)
    grouped = grouped.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
    asked = grouped.join(numbers, "dims")
    copies = shards.withColumn(
        "group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint")))
    ).withColumn("block", F.lit(-1).cast("bigint"))
    columns = ["number", "group", "block", "dims", "n", "keys", "labels", "weights", "windows"]
    met = copies.select(*columns).unionByName(asked.select(*columns))
    together = met.repartition(shuffle_partitions(spark), "number", "group")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, own = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                number, group, block, dims, n = (batch.column(i)[row].as_py() for i in range(5))
                keys, labels, weights, windows = (
                    np.frombuffer(batch.column(i)[row].as_buffer(), "<i8") for i in range(5, 9)
                )
                weights = weights.reshape(n, dims)
                if block < 0:
                    tree, own = Tree(keys, labels, weights), (number, group)
                    continue
                if own != (number, group):
                    raise RuntimeError("a block of queries came without its shard")
                edges: list[list] = [[] for _ in range(n)]
                for i, least, greatest in windows.reshape(-1, 3).tolist():
                    edges[i].append((least, greatest))
                found = []
                for i in range(n):
                    wanted = edges[i] or ([(None, None)] if same else [])
                    results = tree.search(int(keys[i]), int(labels[i]), weights[i], same, wanted, k)
                    for (_, greatest), rows in zip(wanted, results, strict=True):
                        found += [(int(keys[i]), int(labels[i]), greatest, key, s) for s, key in rows]
                cells = list(zip(*found, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.int64()) for c in cells],
                    names=["anchor_id", "label", "window", "key", "score"],
                )

    return (
        together.sortWithinPartitions("number", "group", "block")
        .mapInArrow(search, "anchor_id long, label long, window long, key long, score long")
    )


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    least_share: tuple[int, int] = (80, 100),
) -> DataFrame:
    """For every anchor and its best rows of the same label: the best rows of other labels
    whose score is between a share of the positive's score and that score.

    Components become floor(scale * x) and scores are integer inner products; higher ones
    come first, equal ones by the smaller id.  The share is a fraction (80, 100): with
    positive score p and negative score n, 80 p <= 100 n <= 100 p, so that a negative p has
    no negatives and p = 0 those of score 0.

    Rows with a null id, label or vector, or with a null or non-finite component, take no
    part.  Only vectors of the same length are compared.  A row is never compared with rows
    of its own id.  Rows that repeat an id are rows of their own: each can be a positive
    or a negative.  Anchors that agree in id, label and vector are one anchor; where an id
    has several labels or vectors, its anchors are joined: rows are ranked per anchor id
    and label.  Equal rows of one id and score are one result.  Scores must fit in a long.
    Empty tables give no rows.
    """
    usable = vectors.select(
        F.col(key).cast("long").alias("key"),
        label.cast("long").alias("label"),
        _quantised(F.col(vector), scale).alias("weights"),
        F.coalesce(is_anchor, F.lit(False)).alias("asked"),
    ).where("key IS NOT NULL AND label IS NOT NULL AND weights IS NOT NULL")
    usable = stored(usable.withColumn("dims", F.size("weights")))
    # Tiles over all shards: by label and leading coordinate, equal rows spread by their id.
    parts = max(1, math.ceil(usable.count() / SHARD_ROWS))
    tiles = usable.repartitionByRange(
        parts, "dims", "label", F.get("weights", F.lit(0)), F.xxhash64("key")
    )
    shards = stored(
        _blocks(tiles, SHARD_ROWS).withColumn("number", F.monotonically_increasing_id())
    )
    anchors = usable.where("asked").drop("asked").dropDuplicates(["key", "label", "weights"])
    anchors = stored(anchors)

    ranked = Window.partitionBy("anchor_id", "label").orderBy(F.col("score").desc(), "key")
    near = _searched(shards, _full_blocks(anchors, QUERY_ROWS), True, positives).distinct()
    near = near.withColumn("nth", F.row_number().over(ranked)).where(F.col("nth") <= positives)
    near = stored(near.select("anchor_id", "label", F.col("key").alias("positive_id"), "score"))

    # The least score, ceil(p * 80 / 100), in whole numbers; p is not negative here.
    share, whole = map(int, least_share)
    least = F.expr(f"(score * {share}L + {whole - 1}L) div {whole}L")
    edge = F.struct(least.alias("least"), F.col("score").alias("greatest"))
    windows = (
        near.where("score >= 0")
        .groupBy(F.col("anchor_id").alias("key"), "label")
        .agg(F.collect_set(edge).alias("windows"))
    )
    asked = anchors.join(windows, ["key", "label"])
    far = _searched(shards, _full_blocks(asked, QUERY_ROWS), False, negatives).distinct()
    best = Window.partitionBy("anchor_id", "label", "window").orderBy(F.col("score").desc(), "key")
    far = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    far = far.select(
        "anchor_id",
        "label",
        F.col("window").alias("positive_score"),
        F.col("rank").cast("int").alias("rank"),
        F.col("key").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    pairs = near.withColumnRenamed("score", "positive_score")
    return pairs.join(far, ["anchor_id", "label", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
