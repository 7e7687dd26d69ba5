"""Exact top-k by inner product with MaxScore over signed dimensions.

Every dimension gives two terms, one for its positive and one for its negative
weights, each with postings (vector, weight) in every shard and the largest
weight as its bound. A query adds to a vector's score through the terms whose
sign is its own and takes away through the others, whose bound is zero.

Terms that add are ordered by bound. Those whose bounds sum up to less than the
k-th best score so far are non-essential: a vector in none of the essential
postings cannot enter. The essential postings are traversed; of the vectors found
there, those that could still enter with all non-essential bounds on top are
probed, largest bound first, and dropped as soon as the rest of the bounds does
not suffice. Comparisons keep equal scores, so ties are exact.

Vectors are packed into shards of a fixed number of rows and queries into full blocks.
A shard is sent once to every group of blocks and sorted in front of them; a task holds
one shard and one block at a time, and the best k of all shards are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import shuffle_partitions
from tidegauge.plans.shared import stored

SHARD_ROWS = 8192
QUERY_ROWS = 1024
#: Blocks of queries that one copy of a shard meets.
GROUP_BLOCKS = 16
_SEED_ROWS = 1024
_PROBED_TOGETHER = 8
#: Sums below this are exact in floating point too, which multiplies faster.
_EXACT = 2**53


class Shard:
    """Postings of one shard."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray) -> None:
        self.keys = keys
        self.weights = weights
        self.floats = weights.astype(np.float64)
        self.largest = int(np.abs(weights).max()) if weights.size else 0
        n_dims = weights.shape[1]
        self.bounds = np.zeros((2, n_dims), np.int64)
        self.postings: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]
        for sign, own in ((0, weights), (1, -weights)):
            for d in range(n_dims):
                rows = np.flatnonzero(own[:, d] > 0)
                values = own[rows, d]
                self.postings[sign].append((rows, values))
                self.bounds[sign, d] = values.max() if len(values) else 0

    def _products(self, rows: np.ndarray, dims: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Inner products of some rows with a query, over some dimensions."""
        if self.largest * int(np.abs(query).sum()) < _EXACT:
            part = self.floats[np.ix_(rows, dims)]
            return (part @ query[dims].astype(np.float64)).astype(np.int64)
        return self.weights[np.ix_(rows, dims)] @ query[dims]

    def search(self, key: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and scores of at least the best ``k`` rows but the query's own."""
        others = self.keys != key
        if k < 1 or not others.any():
            return self.keys[:0], np.zeros(0, np.int64)
        # The first rows are scored in full, which gives a score to beat.
        first = np.flatnonzero(others[:_SEED_ROWS])
        if self.largest * int(np.abs(query).sum()) < _EXACT:
            scores = (self.floats[first] @ query.astype(np.float64)).astype(np.int64)
        else:
            scores = self.weights[first] @ query
        if len(first) >= k:
            beat = int(np.partition(scores, len(scores) - k)[len(scores) - k])
        else:
            beat = None
        found_rows, found_scores = [first], [scores]
        if len(self.keys) > _SEED_ROWS:
            rows, scores = self._rest(query, k, beat, others)
            found_rows.append(rows)
            found_scores.append(scores)
        rows, scores = np.concatenate(found_rows), np.concatenate(found_scores)
        best = np.lexsort((self.keys[rows], -scores))[:k]
        return self.keys[rows[best]], scores[best]

    def _rest(
        self, query: np.ndarray, k: int, beat: int | None, others: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        sign = (query < 0).astype(np.int64)
        size = np.abs(query)
        bounds = size * self.bounds[sign, np.arange(len(query))]
        order = np.argsort(bounds, kind="stable")
        below = np.concatenate([[0], np.cumsum(bounds[order])])
        competes = beat is not None and beat > 0  # else a vector in no posting may enter
        split = int(np.searchsorted(below, beat, side="left")) - 1 if competes else 0
        essential = order[split:]
        added = np.zeros(len(self.keys), np.int64)
        open_rows = np.full(len(self.keys), not competes)
        for d in essential.tolist():
            rows, values = self.postings[sign[d]][d]
            added[rows] += size[d] * values
            open_rows[rows] = True
        spare = int(below[split])
        if competes:
            open_rows &= added + spare >= beat
        open_rows &= others
        open_rows[:_SEED_ROWS] = False
        rows = np.flatnonzero(open_rows)
        # Probe the largest weights of the query first; ``reach`` bounds a row's score.
        reach = added[rows] + spare
        score = np.zeros(len(rows), np.int64)
        is_essential = np.zeros(len(query), bool)
        is_essential[essential] = True
        probes = np.argsort(-size, kind="stable")
        for k in range(0, len(probes), _PROBED_TOGETHER):
            dims = probes[k : k + _PROBED_TOGETHER]
            exact = self._products(rows, dims, query)
            score += exact
            # Essential dimensions were counted without what they take away.
            inner = dims[is_essential[dims]]
            counted = np.maximum(self.weights[np.ix_(rows, inner)] * query[inner], 0).sum(axis=1)
            reach += exact - counted - int(bounds[dims[~is_essential[dims]]].sum())
            if beat is not None:
                stay = reach >= beat
                if not stay.all():
                    rows, reach, score = rows[stay], reach[stay], score[stay]
        return rows, score


def _quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) per component; null if a component is null or not finite."""
    good = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return F.when(F.coalesce(good, F.lit(False)), whole)


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows of (key, dims, weights) as blocks of at most ``size`` rows of one dimension."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[int, list[int]]]] = {}

        def block(dims: int) -> pa.RecordBatch:
            pairs = waiting.pop(dims)
            keys = np.array([p[0] for p in pairs], "<i8")
            weights = np.array([p[1] for p in pairs], "<i8").reshape(len(pairs), dims)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([dims], pa.int32()),
                    pa.array([keys.tobytes()]),
                    pa.array([weights.tobytes()]),
                ],
                names=["dims", "keys", "weights"],
            )

        for batch in batches:
            for key, dims, weights in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                waiting.setdefault(dims, []).append((key, weights))
                if len(waiting[dims]) == size:
                    yield block(dims)
        for dims in list(waiting):
            yield block(dims)

    return rows.mapInArrow(pack, "dims int, keys binary, weights binary")


def _numbered(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("number", F.monotonically_increasing_id())


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 1024,
) -> DataFrame:
    """The ``k`` best of all other rows for every row that ``is_query`` holds for.

    Components become floor(scale * x). Returns query_id, rank from 1, vec_id and
    score; equal scores go to the smaller id. A vector that is null, has a null or
    non-finite component, or has a null id takes no part; an empty vector scores 0
    against empty ones. Only vectors of the same length are compared. A query
    meets every row with another id, so repeated ids are never their own answers
    and repeated queries give repeated answers only once. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    usable = vectors.select(
        F.col(key).cast("long").alias("key"),
        _quantised(F.col(vector), scale).alias("weights"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    ).where("key IS NOT NULL AND weights IS NOT NULL")
    usable = usable.withColumn("dims", F.size("weights"))
    shards = stored(_numbered(_packed(usable.select("key", "dims", "weights"), SHARD_ROWS)))
    asked = usable.where("asked").dropDuplicates(["key", "weights"])
    asked = stored(asked.select("key", "dims", "weights"))
    blocks = max(1, math.ceil(asked.count() / QUERY_ROWS))
    asked = stored(_numbered(_packed(asked.repartition(blocks), QUERY_ROWS)))
    groups = max(1, math.ceil(asked.count() / GROUP_BLOCKS))
    asked = asked.select(
        "dims", "keys", "weights",
        F.col("number").alias("block"),
        F.pmod(F.xxhash64("number"), F.lit(groups)).alias("group"),
    )

    # Every block of queries goes to every shard of its dimension: queries against all
    # rows, in blocks. The shard comes first in each of its groups.
    copies = shards.select(
        "number", "dims", "keys", "weights",
        F.lit(-1).cast("bigint").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("group"),
    )
    asked = asked.join(shards.select("dims", "number"), "dims")
    columns = ["number", "group", "block", "dims", "keys", "weights"]
    met = copies.select(*columns).unionByName(asked.select(*columns))
    met = met.repartition(shuffle_partitions(spark), "number", "group")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, own = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                number, group, block, dims = (batch.column(i)[row].as_py() for i in range(4))
                keys, weights = (
                    np.frombuffer(batch.column(i)[row].as_buffer(), "<i8") for i in (4, 5)
                )
                weights = weights.reshape(len(keys), dims)
                if block < 0:
                    shard, own = Shard(keys, weights), (number, group)
                    continue
                if own != (number, group):
                    raise RuntimeError("a block of queries came without its shard")
                found = []
                for key, query in zip(keys.tolist(), weights, strict=True):
                    ids, scores = shard.search(key, query, k)
                    found.append((np.full(len(ids), key), ids, scores))
                cells = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(cells, names=["query_id", "vec_id", "score"])

    pairs = met.sortWithinPartitions("number", "group", "block")
    candidates = pairs.mapInArrow(search, "query_id long, vec_id long, score long").distinct()
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        candidates.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
