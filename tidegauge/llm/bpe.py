"""Byte-level BPE as a reduction over a monoid of encoded texts.

An encoded text and the joining of two neighbours form a monoid, so a text is
encoded by halves, which are encoded by halves in turn, and joined up the tree.

Between pieces (matches of the pattern) a join scans a window around the seam
anew: from the last pieces of the left text that could still change to the first
place where the new scan ends a piece exactly where the right text had begun
one. The pattern never looks back, so from there on both scans agree; and a
piece is final once two characters behind it are known, as no alternative looks
further (a contraction has three characters, and a run of white space gives back
one).

Within a piece a join encodes the last ids of the left and the first ids of the
right anew, and takes in more of either side until the ids at both edges of the
window are compatible with their outer neighbours. Two neighbouring ids are
compatible if their joint bytes encode to just these two. A sequence of which all
neighbours are compatible is the BPE encoding of its bytes, so everything outside
the window has provably come to rest.

Decoding joins the bytes of the ids up the same tree: they stand one after another.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import ranges, remembered, slices, sums, texts_of
from tidegauge.llm.pieces import EXACT, Pattern, PieceIds, patterns, split

#: Texts of at most so many characters are scanned, and pieces of so many bytes merged, at once.
LEAF_CHARACTERS = 4096
LEAF_BYTES = 6
#: Windows of more bytes are merged with a heap.
SCANNED_BYTES = 64
_SETTLED = 2
_REMEMBERED = 60_000


def join_pieces(left: list[str], right: list[str], pattern: Pattern = EXACT) -> list[str]:
    """The pieces of two neighbouring texts together."""
    if not left or not right:
        return left or right
    open_pieces, characters = 0, 0
    while open_pieces < len(left) and characters < _SETTLED:
        open_pieces += 1
        characters += len(left[-open_pieces])
    kept = left[: len(left) - open_pieces]
    tail = "".join(left[len(left) - open_pieces :])
    reach = 2
    while True:
        window = tail + "".join(right[:reach])
        whole = reach >= len(right)
        starts, at = {}, len(tail)
        for i, piece in enumerate(right[:reach]):
            starts[at] = i
            at += len(piece)
        new, end = [], 0
        for piece in split(window, pattern):
            new.append(piece)
            end += len(piece)
            if end in starts and end + _SETTLED <= len(window):
                return kept + new + right[starts[end] :]
        if whole:
            return kept + new
        reach *= 2


def pieces_of(text: str, pattern: Pattern = EXACT) -> list[str]:
    """The matches of the pattern in a text, by halves."""
    if len(text) <= LEAF_CHARACTERS:
        return split(text, pattern)
    middle = len(text) // 2
    left, right = pieces_of(text[:middle], pattern), pieces_of(text[middle:], pattern)
    return join_pieces(left, right, pattern)


class Encoder:
    """Encodes pieces by a table from bytes to ranks; the rank is the id."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self._short: dict[bytes, tuple[int, ...]] = {}
        self._halves: dict[bytes, tuple[int, ...]] = {}

    def merged(self, data: bytes) -> tuple[int, ...]:
        """Merge single bytes, always the lowest rank first and the leftmost of equals."""
        known = self._short.get(data)
        if known is not None:
            return known
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        found = tuple([ranks[p] for p in parts])
        if len(data) <= 32:
            if len(self._short) > _REMEMBERED:
                self._short.clear()
            self._short[data] = found
        return found

    def merged_by_heap(self, data: bytes) -> tuple[int, ...]:
        """What ``merged`` gives, for long byte strings: n log n steps."""
        ranks, size = self.ranks, len(data)
        ends = list(range(1, size + 1))  # of the part that starts here; 0 where none does
        starts = list(range(-1, size))  # of the part that ends here
        open_pairs = []
        for i in range(size - 1):
            rank = ranks.get(data[i : i + 2])
            if rank is not None:
                open_pairs.append((rank, i, i + 1, i + 2))
        heapify(open_pairs)
        while open_pairs:
            _, begin, middle, end = heappop(open_pairs)
            if ends[begin] != middle or ends[middle] != end:
                continue  # one of the two has been merged since
            ends[begin], ends[middle], starts[end] = end, 0, begin
            if begin:
                before = starts[begin]
                rank = ranks.get(data[before:end])
                if rank is not None:
                    heappush(open_pairs, (rank, before, begin, end))
            if end < size:
                behind = ends[end]
                rank = ranks.get(data[begin:behind])
                if rank is not None:
                    heappush(open_pairs, (rank, begin, end, behind))
        found, at = [], 0
        while at < size:
            found.append(ranks[data[at : ends[at]]])
            at = ends[at]
        return tuple(found)

    def compatible(self, left: int, right: int) -> bool:
        """Whether two ids may stand side by side."""
        return self.merged(self.bytes_of[left] + self.bytes_of[right]) == (left, right)

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The ids of two neighbouring byte strings together."""
        if not left or not right:
            return left or right
        a = b = 1
        while True:
            first = len(left) - a
            window = b"".join([self.bytes_of[i] for i in left[first:] + right[:b]])
            # Not by halves: a window of the whole of both sides would be cut as before, without end.
            scanned = len(window) <= SCANNED_BYTES
            new = self.merged(window) if scanned else self.merged_by_heap(window)
            left_rests = first == 0 or self.compatible(left[first - 1], new[0])
            right_rests = b == len(right) or self.compatible(new[-1], right[b])
            if left_rests and right_rests:
                return left[:first] + new + right[b:]
            if not left_rests:
                a = min(len(left), 2 * a)
            if not right_rests:
                b = min(len(right), 2 * b)

    def by_halves(self, data: bytes) -> tuple[int, ...]:
        """Encode halves and join them."""
        if len(data) <= LEAF_BYTES:
            return self.merged(data)
        known = self._halves.get(data)
        if known is not None:
            return known
        middle = len(data) // 2
        found = self.join(self.by_halves(data[:middle]), self.by_halves(data[middle:]))
        if len(data) <= 16:
            if len(self._halves) > _REMEMBERED:
                self._halves.clear()
            self._halves[data] = found
        return found

    def piece(self, data: bytes) -> tuple[int, ...]:
        """The ids of a piece; a piece that is a token is that token."""
        rank = self.ranks.get(data)
        return (rank,) if rank is not None else self.by_halves(data)

    def pieces(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a list of pieces, and ids per piece."""
        found = [self.piece(p.encode("utf-8", "surrogatepass")) for p in new]
        lengths = np.array([len(f) for f in found], np.int64)
        ids = np.fromiter((i for f in found for i in f), np.uint32, lengths.sum())
        return ids, lengths


def _table(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte strings as one array with starts and lengths."""
    lengths = np.array([len(s) for s in strings], np.int64)
    return np.frombuffer(b"".join(strings), np.uint8), np.cumsum(lengths) - lengths, lengths


class Codec:
    """Encodes and decodes batches of texts."""

    def __init__(self, rank_file: bytes) -> None:
        ranks = {}
        for line in rank_file.splitlines():
            if line:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.encoder = Encoder(ranks)
        self._known = PieceIds(self.encoder.pieces)
        size = max(ranks.values()) + 1
        self._bytes = _table([self.encoder.bytes_of.get(i, b"") for i in range(size)])
        self._decimal = _table([b" %d" % i for i in range(size)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and ids per text."""
        return self._known(list(map(pieces_of, texts, patterns(texts))))

    @staticmethod
    def _strings(table, ids: np.ndarray, lengths: np.ndarray) -> list[memoryview]:
        """The table's strings of each text's ids, one after another."""
        data, starts, sizes = table
        each = sizes[ids]
        flat = memoryview(data[ranges(starts[ids], each)].tobytes())
        ends = np.cumsum(sums(each, lengths))
        begins = np.append(0, ends[:-1])
        return [flat[b:e] for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[memoryview]:
        """The bytes of each text."""
        return self._strings(self._bytes, ids, lengths)

    def decimals(self, ids: np.ndarray, lengths: np.ndarray) -> list[memoryview]:
        """Each text's ids in decimal, joined by one blank."""
        return [s[1:] for s in self._strings(self._decimal, ids, lengths)]


def codec(rank_file: bytes) -> Codec:
    """The codec of a rank file; a Python worker builds it once."""
    name = hashlib.sha256(rank_file).hexdigest()
    return remembered(("codec", name), lambda: Codec(rank_file), large=True)


def _broadcast(documents: DataFrame, rank_path: str) -> Broadcast:
    with open(rank_path, "rb") as file:
        return documents.sparkSession.sparkContext.broadcast(file.read())


def encoded(
    documents: DataFrame, rank_path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id`` and ``ids`` of every whole text.

    A null or empty text has no ids. Each row is encoded on its own, so repeated
    keys and null keys stay as they are, and an empty table gives no rows. Other
    columns are ignored. The rank file is read by the driver and sent to the tasks.
    """
    ranks = _broadcast(documents, rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, lengths = codec(ranks.value).encode(texts_of(batch))
            offsets = pa.array(np.append(0, np.cumsum(lengths)), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists], names=["doc_id", "ids"]
            )

    chosen = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, ids array<int>")


def decoded(encodings: DataFrame, rank_path: str) -> DataFrame:
    """``doc_id`` and ``content`` (the bytes) of rows with ``doc_id`` and ``ids``."""
    ranks = _broadcast(encodings, rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.array(i or [], np.int64) for i in batch.column("ids").to_pylist()]
            lengths = np.array([len(i) for i in lists], np.int64)
            ids = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            content = [bytes(c) for c in codec(ranks.value).decode(ids, lengths)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(content, pa.binary())],
                names=["doc_id", "content"],
            )

    return encodings.select("doc_id", "ids").mapInArrow(run, "doc_id long, content binary")


def encoding_digests(
    documents: DataFrame, rank_path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids in decimal and of the decoded bytes.

    One pass: a task encodes its texts and decodes the ids at once. Cases are
    those of ``encoded``; a text without ids has the digests of the empty string.
    """
    ranks = _broadcast(documents, rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = codec(ranks.value)
            ids, lengths = own.encode(texts_of(batch))
            digests = [
                pa.array([hashlib.sha256(s).hexdigest() for s in strings])
                for strings in (own.decimals(ids, lengths), own.decode(ids, lengths))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths), *digests],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    chosen = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
