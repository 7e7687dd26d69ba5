"""Centroid clustering with the equal-average equal-variance nearest search.

Vectors and centroids are whole numbers.  With the sum S and the scaled deviation
V = sqrt(n * sum of squares - S * S) of an n-component vector, for every centroid c

    n * distance(x, c) >= (S(x) - S(c))^2                          (equal average)
    n * distance(x, c) >= (S(x) - S(c))^2 + (V(x) - V(c))^2        (equal variance)

Centroids are sorted by their component sum, which is their mean times n.  A vector's
search starts at its own sum and goes outward, the nearer side first.  When the first
bound exceeds the best distance, so do those of all centroids further out, and the search
ends; a centroid that the second bound excludes is passed over.  Distances of the others
are taken in whole numbers; only a bound strictly above the best distance excludes, so
ties are exact.  All vectors of a batch take each step together.

Each round sums every cluster's vectors within the tasks and merges one row per task and
cluster; the centroids, k vectors, are all that the driver holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.plans.shared import stored

_BATCH = 4096


def largest_component(dims: int) -> int:
    """Up to here all sums, squares and distances of quantised vectors fit in a long."""
    return 2**30 // max(dims, 1)


class Nearest:
    """The nearest of some centroids, ties to the smaller number."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.dims = centroids.shape[1]
        sums = centroids.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.centroids = centroids[self.order]
        self.sums = sums[self.order]
        self.deviations = self._deviations(self.centroids, self.sums)

    def _deviations(self, rows: np.ndarray, sums: np.ndarray) -> np.ndarray:
        return np.sqrt(self.dims * np.einsum("ij,ij->i", rows, rows) - sums * sums)

    def find(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of every row's nearest centroid."""
        n, k = len(rows), len(self.order)
        sums = rows.sum(axis=1)
        deviations = self._deviations(rows, sums)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, -1, np.int64)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        active = np.arange(n)
        while len(active):
            lower, upper = left[active], right[active]
            own = sums[active]
            below = np.where(lower >= 0, own - self.sums[np.maximum(lower, 0)], np.inf)
            above = np.where(upper < k, self.sums[np.minimum(upper, k - 1)] - own, np.inf)
            goes_down = below <= above
            gap = np.where(goes_down, below, above)
            # Sums are exact and roots nearly so; a bound as close as their error is no bound.
            limit = self.dims * best[active].astype(np.float64) * (1 + 1e-9) + 1
            open_rows = gap * gap <= limit
            at = np.where(goes_down, lower, upper)[open_rows]
            goes_down, gap, limit = goes_down[open_rows], gap[open_rows], limit[open_rows]
            active = active[open_rows]
            left[active[goes_down]] -= 1
            right[active[~goes_down]] += 1
            away = np.abs(deviations[active] - self.deviations[at])
            probed = gap * gap + away * away <= limit
            rows_now, at = active[probed], at[probed]
            difference = rows[rows_now] - self.centroids[at]
            distance = np.einsum("ij,ij->i", difference, difference)
            named = self.order[at]
            known, holder = best[rows_now], number[rows_now]
            better = (distance < known) | ((distance == known) & (named < holder))
            taken = rows_now[better]
            best[taken], number[taken] = distance[better], named[better]
        return number, best


def _quantised(vector: Column, scale: int, dims: int) -> Column:
    """floor(scale * x) of vectors with ``dims`` finite components, else null."""
    good = (F.size(vector) == dims) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return F.when(F.coalesce(good, F.lit(False)), whole)


def _batches(
    batches: Iterator[pa.RecordBatch], dims: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Small batches with their vectors as whole numbers."""
    for batch in batches:
        for start in range(0, batch.num_rows, _BATCH):
            part = batch.slice(start, _BATCH)
            flat = part.column("weights").flatten().to_numpy(zero_copy_only=False)
            if len(flat) and max(-int(flat.min()), int(flat.max())) > largest_component(dims):
                raise OverflowError(f"a component is beyond {largest_component(dims)}")
            yield part, flat.reshape(part.num_rows, dims)


def _first(vectors: DataFrame, k: int, seed: Column) -> np.ndarray:
    """The ``k`` vectors of the smallest seeds; equal seeds go by id and components."""
    rows = vectors.orderBy(seed, "key", "weights").limit(k).select("weights").collect()
    return np.array([r["weights"] for r in rows], np.int64)


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid as the floored mean of its vectors; without vectors it stays."""
    k, dims = centroids.shape

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids)
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, rows in _batches(batches, dims):
            number, _ = nearest.find(rows)
            np.add.at(sums, number, rows)
            counts += np.bincount(number, minlength=k)
        held = np.flatnonzero(counts)
        if len(held):
            yield pa.RecordBatch.from_arrays(
                [pa.array(held), pa.array(counts[held]), pa.array(list(sums[held]))],
                names=["cluster", "rows", "sums"],
            )

    parts = vectors.select("weights").mapInArrow(
        gather, "cluster long, rows long, sums array<long>"
    )
    # One row per task and cluster meet; sums of sums may need more than a long.
    totals = (
        parts.select("cluster", "rows", F.posexplode("sums").alias("place", "part"))
        .groupBy("cluster", "place")
        .agg(
            F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("rows").alias("rows")
        )
        .collect()
    )
    moved = centroids.copy()
    for row in totals:
        moved[row["cluster"], row["place"]] = int(row["total"]) // row["rows"]
    return moved


def clusters(
    vectors: DataFrame,
    seed: Column,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
) -> tuple[DataFrame, np.ndarray]:
    """Every usable vector with its cluster and squared distance, and the centroids.

    Vectors with exactly ``dims`` components, none null or non-finite, are kept; component
    x becomes floor(scale * x).  The centroids start as the ``k`` vectors of the smallest
    ``seed`` (an expression over ``vectors``), in that order; equal seeds, as repeated rows
    have, go by id and components, and fewer rows give fewer centroids.  Each of ``rounds``
    rounds assigns all vectors to the nearest centroid, ties to the smaller number, and
    moves every centroid that has vectors to their floored mean; then vectors are assigned
    once more.  Gives (key, cluster, distance) per row, repeated and null ids included;
    an empty table gives no rows.  A quantised component beyond ``largest_component`` is an
    error, as distances could leave a long.
    """
    usable = vectors.select(
        F.col(key).alias("key"),
        seed.alias("seed"),
        _quantised(F.col(vector), scale, dims).alias("weights"),
    ).where("weights IS NOT NULL")
    usable = stored(usable)
    centroids = _first(usable, k, F.col("seed")).reshape(-1, dims)
    kind = usable.schema["key"].dataType
    schema = f"key {kind.simpleString()}, cluster int, distance long"
    if not len(centroids):
        return usable.sparkSession.createDataFrame([], schema), centroids
    for _ in range(rounds):
        centroids = _moved(usable, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids)
        for batch, rows in _batches(batches, dims):
            number, distance = nearest.find(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(number.astype(np.int32)), pa.array(distance)],
                names=["key", "cluster", "distance"],
            )

    return usable.select("key", "weights").mapInArrow(assign, schema), centroids


def _digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_report(
    vectors: DataFrame, k: int = 16, rounds: int = 3, key: str = "vec_id", **options
) -> DataFrame:
    """The clusters with their inertia, that of all vectors, and the centroid's digest.

    Seeds are the sha256 of ``1:<id>``.  A centroid's digest is the sha256 of its final
    components as decimals joined by commas.
    """
    seed = F.sha2(F.concat(F.lit("1:"), F.col(key).cast("string")).cast("binary"), 256)
    # A null id has no seed; it comes last.
    seed = F.coalesce(seed, F.lit("~"))
    found, centroids = clusters(vectors, seed, k, rounds, key=key, **options)
    found = stored(found)
    # One row per cluster, k at most.
    sums = {
        r["cluster"]: r["inertia"]
        for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()
    }
    rows = [
        (c, total, sum(sums.values()), _digest(centroids[c])) for c, total in sorted(sums.items())
    ]
    per_cluster = vectors.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.withColumnRenamed("key", key).join(F.broadcast(per_cluster), "cluster").select(
        key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
