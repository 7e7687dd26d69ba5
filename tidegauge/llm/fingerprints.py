"""Fingerprints from locally consistent parsing.

A text is parsed into phrases level by level. Runs of an equal symbol become one
symbol; between runs, deterministic coin tossing gives each symbol a small label
from the lowest bit in which it differs from its left neighbour, again and again
until labels are below six; a symbol whose label is a local minimum begins a new
phrase. So where phrases begin depends on a few neighbouring symbols only, and a
phrase is named by a hash of what it holds. Equal substrings get equal names
inside wherever they stand, and the names of a level are the symbols of the next.

A fingerprint keeps, for each of a few levels, the smallest hashes of the names
that occur there. Two fingerprints are compared on the highest level where both
have enough of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import (
    bucket_of,
    cut_points,
    ranges,
    shuffle_partitions,
    slices,
)

LEVELS = 3
KEPT = 32
_ENOUGH = 12
_ROUNDS = 4
_ONE = np.uint64(1)
_STRIDE = np.uint64(0x9E3779B97F4A7C15)
#: Texts are parsed together up to so many bytes, which keeps the arrays in the caches.
_TOGETHER = 400_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers, in place."""
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9FB21C651E98DF25)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


def _lowest_bit(x: np.ndarray) -> np.ndarray:
    """Place of the lowest set bit of nonzero numbers."""
    low = x & (~x + x.dtype.type(1))
    if low.dtype == np.uint8:
        return _PLACE[low]
    with np.errstate(over="ignore"):
        return _WIDE_PLACE[(low * _SPREAD) >> np.uint64(58)]


_PLACE = np.zeros(256, np.uint8)
_PLACE[[1 << i for i in range(8)]] = np.arange(8)
#: A de Bruijn number: shifting it by 0 to 63 bits gives 64 different upper six bits.
_SPREAD = np.uint64(0x03F79D71B4CB0A89)
_WIDE_PLACE = np.zeros(64, np.uint8)
_WIDE_PLACE[[((0x03F79D71B4CB0A89 << i) & (2**64 - 1)) >> 58 for i in range(64)]] = np.arange(64)


def _tossed(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below six; neighbours within a text differ. ``first`` marks first symbols."""
    labels = symbols
    for _ in range(_ROUNDS):
        left = np.empty_like(labels)
        left[1:] = labels[:-1]
        left[:1] = 0
        left[first] = ~labels[first]  # differs in the lowest bit
        place = _lowest_bit(labels ^ left)
        bit = (labels >> place.astype(labels.dtype)) & labels.dtype.type(1)
        labels = (place << 1) | bit.astype(np.uint8)
    return labels


def _next_level(symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of many sequences, and how many each sequence has."""
    with np.errstate(over="ignore"):
        owner_start = np.cumsum(counts) - counts
        first = np.zeros(len(symbols), bool)
        first[owner_start[counts > 0]] = True
        # Runs.
        begins = first.copy()
        begins[1:] |= symbols[1:] != symbols[:-1]
        if not begins.all():
            at = np.flatnonzero(begins)
            lengths = np.diff(at, append=len(symbols)).astype(np.uint64)
            totals = np.concatenate([[0], np.cumsum(begins)])
            counts = totals[owner_start + counts] - totals[owner_start]
            symbols, first = symbols[at], first[at]
            longer = lengths > _ONE
            if longer.any():
                symbols = symbols.copy()
                symbols[longer] = _mixed(symbols[longer] + lengths[longer] * _STRIDE)
                # Neighbouring runs still differ, but for a collision of hashes.
                same = np.flatnonzero((symbols[1:] == symbols[:-1]) & ~first[1:]) + 1
                symbols[same] ^= _ONE
        labels = _tossed(symbols, first)
        # A local minimum begins a phrase; ends of a sequence do not count as neighbours.
        begins = first.copy()
        if len(labels) > 2:
            low = (labels[1:-1] < labels[:-2]) & (labels[1:-1] < labels[2:])
            begins[1:-1] |= low & ~first[1:-1] & ~first[2:]
        at = np.flatnonzero(begins)
        lengths = np.diff(at, append=len(symbols))
        names = symbols[at].copy()
        _mixed(names)
        for k in range(1, int(lengths.max()) if len(lengths) else 0):
            more = np.flatnonzero(lengths > k)
            part = names[more] * np.uint64(3) + symbols[at[more] + k]
            names[more] = _mixed(part)
        totals = np.concatenate([[0], np.cumsum(begins)])
        owner_start = np.cumsum(counts) - counts
        return names, totals[owner_start + counts] - totals[owner_start]


def parse(texts: list[str], levels: int = LEVELS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level from 1: the names of all texts, and how many each text has."""
    symbols = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    counts = np.array([len(t) for t in texts], np.int64)
    symbols = symbols.astype(np.uint64)
    found = []
    for _ in range(levels):
        symbols, counts = _next_level(symbols, counts)
        found.append((symbols, counts))
    return found


class Sketch(NamedTuple):
    """The smallest hashes of each level, rising, and the same in hexadecimal."""

    levels: tuple[list[int], ...]
    fingerprint: str


def _smallest(names: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest 32-bit hashes of each sequence's names, and how many; repeats count."""
    low = np.uint64(0xFFFFFFFF)
    owner = np.repeat(np.arange(len(counts), dtype=np.uint64) << np.uint64(32), counts)
    keys = np.sort(owner | (names >> np.uint64(32)))
    begins = np.ones(len(keys), bool)
    begins[1:] = keys[1:] != keys[:-1]
    if not begins.all():
        at = np.flatnonzero(begins)
        repeat = np.arange(len(keys)) - np.repeat(at, np.diff(at, append=len(keys)))
        other = _mixed((keys & low) + repeat.astype(np.uint64) * _STRIDE) >> np.uint64(32)
        keys = np.sort(np.where(repeat == 0, keys, (keys & ~low) | other))
        keys = np.delete(keys, np.flatnonzero(keys[1:] == keys[:-1]))
    found = np.bincount((keys >> np.uint64(32)).astype(np.int64), minlength=len(counts))
    kept = np.minimum(found, KEPT)
    return (keys[ranges(np.cumsum(found) - found, kept)] & low).astype(np.uint32), kept


def sketches(texts: list[str]) -> list[Sketch]:
    """The sketch of each text."""
    numbers, strings = [], []
    for names, counts in parse(texts):
        hashes, kept = _smallest(names, counts)
        ends = np.cumsum(kept)
        spans = list(zip((ends - kept).tolist(), ends.tolist(), strict=True))
        plain, digits = hashes.tolist(), hashes.astype(">u4").tobytes().hex()
        numbers.append([plain[b:e] for b, e in spans])
        strings.append([digits[8 * b : 8 * e] for b, e in spans])
    pairs = zip(zip(*numbers, strict=True), zip(*strings, strict=True), strict=True)
    return [Sketch(levels, ":".join(own)) for levels, own in pairs]


def likeness(a: tuple[list[int], ...], b: tuple[list[int], ...]) -> float:
    """Share of common names, from 0 to 1; 1 for equal sketches."""
    chosen = 0
    for level in range(len(a)):
        if min(len(a[level]), len(b[level])) >= _ENOUGH:
            chosen = level
    x, y = set(a[chosen]), set(b[chosen])
    both, either = x & y, x | y
    if not either:
        return 1.0
    if max(len(x), len(y)) < KEPT:
        return len(both) / len(either)
    # The smallest of the union are a sample of it.
    sample = sorted(either)[:KEPT]
    return sum([h in both for h in sample]) / len(sample)


def compare(a: str, b: str) -> float:
    """Likeness of two fingerprints."""
    levels = [
        tuple(np.frombuffer(bytes.fromhex(x), ">u4").tolist() for x in f.split(":")) for f in (a, b)
    ]
    return likeness(*levels)


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every whole text.

    A null or empty text has the fingerprint of nothing, which is like itself
    only. Equal texts have equal fingerprints. Rows are independent: null and
    repeated ids stay, and an empty table gives no rows. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=_TOGETHER):
            found = sketches([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s.fingerprint for s in found])],
                names=["doc_id", "fingerprint"],
            )

    chosen = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, fingerprint string")


def _with_guests(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Documents in buckets of falling id, each bucket followed by the next one's first row.

    Only the cut points and the largest id of each bucket meet on the driver.
    """
    parts = shuffle_partitions(documents.sparkSession)
    chosen = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    cuts = cut_points(chosen, "doc_id", 4 * parts)
    last = len(cuts) + 1
    # Buckets count up from the largest ids; null ids come last.
    turned = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(
        F.lit(last - 1) - bucket_of(F.col("doc_id"), cuts)
    )
    placed = chosen.withColumn("bucket", turned)
    heads = sorted(
        (r["bucket"], r["doc_id"])
        for r in chosen.select("doc_id", turned.alias("bucket"))
        .groupBy("bucket")
        .agg(F.max("doc_id").alias("doc_id"))
        .collect()
    )
    homes = {}
    for i, (bucket, _) in enumerate(heads):
        homes[heads[(i + 1) % len(heads)][1]] = bucket
    ids = [i for i in homes if i is not None]
    first = chosen.where(F.col("doc_id").isin(ids) if ids else F.lit(False))
    if None in homes:
        first = first.unionByName(chosen.where(F.col("doc_id").isNull()))
    # As in the order of a bucket, a missing text comes first.
    head = F.min(F.struct(F.col("text").isNotNull().alias("known"), "text"))
    first = first.groupBy("doc_id").agg(head.alias("head")).select("doc_id", "head.text")
    home = documents.sparkSession.createDataFrame(list(homes.items()), "id long, bucket int")
    guests = first.join(F.broadcast(home), F.col("doc_id").eqNullSafe(F.col("id"))).select(
        "doc_id", "text", "bucket", F.lit(1).alias("guest")
    )
    return (
        placed.select("doc_id", "text", "bucket", F.lit(0).alias("guest"))
        .unionByName(guests)
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), "text")
    )


EDIT_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edit_report(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of texts, of their edited forms, and their likeness.

    The edited text has its last floor(n / 3) characters replaced by the first as
    many (or all) of the next document in falling id order; after the last comes
    the first. Null ids come last, equal ids are ordered by text (null first); a
    null text is empty. A single document is its own next one. Empty tables give
    no rows, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, whose next document is not known yet
        for batch in slices(batches, limit=_TOGETHER):
            ids = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            guests = batch.column("guest").to_pylist()
            own = sketches(texts)
            rows = list(zip(ids, texts, guests, own, strict=True))
            if held is not None:
                rows.insert(0, held)
            pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if not a[2]]
            held = rows[-1]
            if pairs:
                yield _edits(pairs)

    def _edits(pairs) -> pa.RecordBatch:
        edited = []
        for (_, text, _, _), (_, following, _, _) in pairs:
            n = len(text) // 3
            edited.append(text[: len(text) - n] + following[:n])
        after = sketches(edited)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([a[0] for a, _ in pairs], pa.int64()),
                pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                pa.array(
                    [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]
                ),
                pa.array([a[3].fingerprint for a, _ in pairs]),
                pa.array([s.fingerprint for s in after]),
                pa.array(
                    [likeness(a[3].levels, s.levels) for (a, _), s in zip(pairs, after, strict=True)]
                ),
                pa.array([likeness(a[3].levels, b[3].levels) for a, b in pairs]),
            ],
            names=[c.split()[0] for c in EDIT_SCHEMA.split(", ")],
        )

    return _with_guests(documents, key, text).mapInArrow(run, EDIT_SCHEMA)
