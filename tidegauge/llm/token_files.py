"""Token ids in files: Simple-8b words in blocks that decode without loops over ids.

A file holds documents in ascending id order. Its rows are blocks of whole
documents; Parquet is only the container, which gives a commit protocol, works
on any store Spark can reach and lets readers split files. A block is one byte
string, all numbers little-endian:

    magic "S8B1", n_docs u32, n_ids u64, n_words u32, n_frames u32
    ids per document      n_docs * u32
    first word of a frame n_frames * u32
    words                 n_words * u64

Every ``FRAME`` ids form a frame that starts a new word, so frames are coded and
decoded side by side, and any of them can be read alone. A word has a selector in
its upper four bits and 60 bits of payload, the first id lowest. Selectors 0 to
12 pack as many ids as 60 bits hold at a width of 1 to 30 bits; 15 is the escape:
one id that is wider. The last word of a frame may be filled up with zeros.
"""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from tidegauge.llm.common import (
    bucket_of,
    cut_points,
    ranges,
    remembered,
    shuffle_partitions,
    slices,
    texts_of,
)
from tidegauge.llm.pieces import PieceIds, patterns, split
from tidegauge.plans.shared import new_folder

FRAME = 128
BLOCK_IDS = 1 << 18
_HEAD = "<4sIQII"
_TOGETHER = 2_000_000
#: Distinct pieces that a task's memory holds.
REMEMBERED = 1_100_000
_MAGIC = b"S8B1"
_PAYLOAD = 60
_ESCAPE = 15
#: Ids per word of selectors 0..12, most first.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2)
WIDTHS = tuple(_PAYLOAD // c for c in COUNTS)
_COUNT_OF = np.ones(16, np.int64)
_COUNT_OF[: len(COUNTS)] = COUNTS


_SMALL_BITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _bits(ids: np.ndarray) -> np.ndarray:
    """Width of each id."""
    if not len(ids) or ids.max() < len(_SMALL_BITS):
        return _SMALL_BITS[ids]
    return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)


def _selectors(ids: np.ndarray) -> np.ndarray:
    """For each position of whole frames, the selector that a word starting there takes."""
    widest = _bits(ids).reshape(-1, FRAME)
    chosen = np.full(widest.shape, _ESCAPE, np.uint8)
    reach = 1
    for selector in range(len(COUNTS) - 1, -1, -1):
        count, width = COUNTS[selector], WIDTHS[selector]
        while reach < count:  # widest id among the next ``reach`` ones
            step = min(reach, count - reach)
            widest[:, :-step] = np.maximum(widest[:, :-step], widest[:, step:])
            reach += step
        np.copyto(chosen, selector, where=widest <= width)
    return chosen


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the ids, and the first word of each frame."""
    frames = -(-len(ids) // FRAME)
    padded = np.zeros(frames * FRAME, np.uint64)
    padded[: len(ids)] = ids
    chosen = _selectors(padded)
    sizes = np.full(frames, FRAME, np.int64)
    if frames:
        sizes[-1] = len(ids) - (frames - 1) * FRAME
    at = np.zeros(frames, np.int64)
    starts = np.zeros(frames * FRAME, bool)
    active = np.flatnonzero(at < sizes)
    while len(active):
        starts[active * FRAME + at[active]] = True
        at[active] += _COUNT_OF[chosen[active, at[active]]]
        active = active[at[active] < sizes[active]]
    start = np.flatnonzero(starts)
    selector = chosen.reshape(-1)[start]
    words = selector.astype(np.uint64) << np.uint64(_PAYLOAD)
    # Zeros behind each frame, as its last word may reach past it.
    space = np.zeros((frames, FRAME + COUNTS[0]), np.uint64)
    space[:, :FRAME] = padded.reshape(-1, FRAME)
    space = space.reshape(-1)
    place = start + start // FRAME * COUNTS[0]
    for s in np.flatnonzero(np.bincount(selector)):
        where = np.flatnonzero(selector == s)
        count = int(_COUNT_OF[s])
        first = place[where]
        taken = space[first]
        for step in range(1, count):
            taken |= space[first + step] << np.uint64(step * (_PAYLOAD // count))
        words[where] |= taken
    per_frame = np.count_nonzero(starts.reshape(-1, FRAME), axis=1)
    return words, (np.cumsum(per_frame) - per_frame).astype(np.uint32)


def unpack(words: np.ndarray, first_words: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of ``pack``; ``first_words`` names the frames' first words."""
    out = np.zeros(n_ids, np.uint32)
    if not n_ids:
        return out
    selector = (words >> np.uint64(_PAYLOAD)).astype(np.int64)
    counts = _COUNT_OF[selector]
    before = np.cumsum(counts) - counts
    per_frame = np.diff(np.append(first_words.astype(np.int64), len(words)))
    frame = np.repeat(np.arange(len(first_words)), per_frame)
    start = frame * FRAME + before - before[first_words.astype(np.int64)][frame]
    end = np.minimum((frame + 1) * FRAME, n_ids)
    for s in np.unique(selector):
        where = np.flatnonzero(selector == s)
        count = int(_COUNT_OF[s])
        width = _PAYLOAD // count
        steps = np.arange(count)
        mask = np.uint64((1 << width) - 1)
        values = (words[where, None] >> (steps * width).astype(np.uint64)) & mask
        places = start[where, None] + steps
        inside = places < end[where, None]
        out[places[inside]] = values[inside]
    return out


def block_bytes(ids: np.ndarray, per_document: np.ndarray) -> bytes:
    """A block of whole documents."""
    words, first_words = pack(ids)
    head = struct.pack(_HEAD, _MAGIC, len(per_document), len(ids), len(words), len(first_words))
    parts = (per_document.astype("<u4"), first_words.astype("<u4"), words.astype("<u8"))
    return head + b"".join(p.tobytes() for p in parts)


def read_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a block, and ids per document."""
    magic, n_docs, n_ids, n_words, n_frames = struct.unpack_from(_HEAD, block)
    if magic != _MAGIC:
        raise ValueError("not a Simple-8b block")
    at = struct.calcsize(_HEAD)
    per_document = np.frombuffer(block, "<u4", n_docs, at)
    at += 4 * n_docs
    first_words = np.frombuffer(block, "<u4", n_frames, at)
    at += 4 * n_frames
    return unpack(np.frombuffer(block, "<u8", n_words, at), first_words, n_ids), per_document


def _visible_bytes() -> np.ndarray:
    """For each byte, the character that stands for it in a byte-level vocabulary.

    Visible characters of Latin-1 stand for themselves, the other bytes for the
    characters from 256 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    characters = np.arange(256, dtype="<u4")
    hidden = np.setdiff1d(characters, visible)
    characters[hidden] = 256 + np.arange(len(hidden))
    return characters


def _encoder(definition: str) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """Texts to (all ids, ids per text) with a tokenizer's JSON definition.

    A byte-level tokenizer splits by the public pattern first and gives the pieces
    to its model one by one, so the model need see each distinct piece only once.
    Other tokenizers get whole texts, and so does every tokenizer where a text holds
    the string of an added token, which the library takes out first.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark spreads the work
    tokenizer = Tokenizer.from_str(definition)

    def whole(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        lengths = np.array([len(f) for f in found], np.int64)
        flat = [np.array(f.ids, np.uint32) for f in found]
        return np.concatenate(flat) if flat else np.zeros(0, np.uint32), lengths

    kind = repr(tokenizer.pre_tokenizer).replace(" ", "")
    by_piece = (
        tokenizer.normalizer is None
        and isinstance(tokenizer.model, BPE)
        and kind.startswith("ByteLevel(add_prefix_space=False")
        and "use_regex=True" in kind
    )
    if not by_piece:
        return whole
    tokenize, visible = tokenizer.model.tokenize, _visible_bytes()

    def pieces(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # Byte 255, which UTF-8 never has and which stands for itself, parts the pieces.
        joined = b"\xff".join([p.encode("utf-8", "surrogatepass") for p in new])
        characters = visible[np.frombuffer(joined, np.uint8)]
        found = list(map(tokenize, characters.tobytes().decode("utf-32-le").split("\xff")))
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = map(attrgetter("id"), chain.from_iterable(found))
        return np.fromiter(ids, np.uint32, lengths.sum()), lengths

    known = PieceIds(pieces, REMEMBERED)
    contents = [t.content for t in tokenizer.get_added_tokens_decoder().values() if t.content]

    def by_pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return known(list(map(split, texts, patterns(texts))))

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        holds = np.array([any(c in t for c in contents) for t in texts], bool)
        if not holds.any():
            return by_pieces(texts)
        lengths = np.zeros(len(texts), np.int64)
        found = []
        for own, kind_of in ((np.flatnonzero(~holds), by_pieces), (np.flatnonzero(holds), whole)):
            if len(own):
                ids, lengths[own] = kind_of([texts[i] for i in own.tolist()])
                found.append((own, ids))
        starts = np.cumsum(lengths) - lengths
        together = np.empty(int(lengths.sum()), np.uint32)
        for own, ids in found:
            together[ranges(starts[own], lengths[own])] = ids
        return together, lengths

    return encode


def _blocks(
    batches: Iterator[pa.RecordBatch], definition: Broadcast, end_id: int
) -> Iterator[pa.RecordBatch]:
    """Encode sorted documents and put them into blocks, bucket by bucket."""
    name = hashlib.sha256(definition.value.encode()).hexdigest()
    encode = remembered(("tokenizer", name), lambda: _encoder(definition.value))
    bucket, start = None, 0
    for batch in slices(batches, limit=_TOGETHER):
        ids, lengths = encode(texts_of(batch))
        lengths = lengths + 1
        ends = np.cumsum(lengths)
        full = np.full(int(ends[-1]), end_id, np.uint32)
        full[ranges(ends - lengths, lengths - 1)] = ids
        buckets = batch.column("bucket").to_numpy(zero_copy_only=False)
        keys = batch.column("key")
        first = 0
        while first < len(lengths):
            if buckets[first] != bucket:
                bucket, start = int(buckets[first]), 0
            before = int(ends[first] - lengths[first])
            last = int(np.searchsorted(ends, before + BLOCK_IDS, side="right"))
            last = min(max(last, first + 1), int(np.searchsorted(buckets, bucket, "right")))
            n = int(ends[last - 1]) - before
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([bucket], pa.int32()),
                    pa.array([start], pa.int64()),
                    pa.array([n], pa.int64()),
                    pa.array([keys[first:last].to_pylist()], pa.list_(pa.int64())),
                    pa.array(
                        [block_bytes(full[before : before + n], lengths[first:last])],
                        pa.binary(),
                    ),
                ],
                names=["bucket", "start", "n_ids", "keys", "block"],
            )
            start += n
            first = last


BLOCK_SCHEMA = "bucket int, start long, n_ids long, keys array<long>, block binary"


def write_token_files(
    documents: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode whole texts and write them to ``folder`` in ascending ``key`` order.

    Documents go to ranges of the key (null keys last), are sorted there and
    encoded in one pass; a task writes its ranges one after another. A null text
    is empty; every document ends with ``end_id``; equal keys are ordered by text
    and all are kept. An empty table gives an empty file. Other columns are
    ignored. The tokenizer file is read by the driver and sent to the tasks.
    """
    spark = documents.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    parts = shuffle_partitions(spark)
    chosen = documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    cuts = cut_points(chosen, "key", 8 * parts)
    placed = (
        chosen.withColumn("bucket", bucket_of(F.col("key"), cuts))
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "key", "text")
    )
    placed.mapInArrow(
        lambda batches: _blocks(batches, definition, end_id), BLOCK_SCHEMA
    ).write.option("compression", "uncompressed").parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks of a folder, with ``first``: the number of ids before the block.

    Only the totals per range of keys meet on the driver; there are as many
    ranges as the writer made.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(folder)
    totals = blocks.groupBy("bucket").agg(F.sum("n_ids").alias("n")).collect()
    before, offsets = 0, []
    for row in sorted(totals, key=lambda r: r["bucket"]):
        offsets.append((row["bucket"], before))
        before += row["n"]
    known = spark.createDataFrame(offsets, "bucket int, before long")
    return blocks.join(F.broadcast(known), "bucket").select(
        (F.col("before") + F.col("start")).alias("first"), "keys", "block"
    )


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(
            batch.column("first").to_pylist(),
            batch.column("keys").to_pylist(),
            batch.column("block"),
            strict=True,
        )
        for first, keys, block in rows:
            ids, lengths = read_block(block.as_buffer().to_pybytes())
            ends = np.cumsum(lengths.astype(np.int64))
            raw = memoryview(ids.astype("<u4").tobytes())
            begins = ends - lengths
            crc = [
                zlib.crc32(raw[4 * b : 4 * e])
                for b, e in zip(begins.tolist(), ends.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(first + begins, pa.int64()),
                    pa.array(lengths.astype(np.int64)),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def file_index(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: where its ids start, how many there are, and their CRC-32.

    Everything comes from the decoded files.
    """
    return read_token_files(spark, folder).mapInArrow(
        _described, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a folder: ``doc_id``, ``start`` and ``ids``."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths = read_block(row["block"])
                offsets = np.append(0, np.cumsum(lengths, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["keys"], pa.int64()),
                        pa.array(row["first"] + offsets[:-1], pa.int64()),
                        pa.ListArray.from_arrays(
                            pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int64))
                        ),
                    ],
                    names=["doc_id", "start", "ids"],
                )

    return read_token_files(spark, folder).mapInArrow(
        decoded, "doc_id long, start long, ids array<long>"
    )


def token_index(
    documents: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None
) -> DataFrame:
    """Write documents to a new folder below the shared one and describe the files."""
    spark = documents.sparkSession
    folder = folder or new_folder(spark, "tokens")
    write_token_files(documents, folder, tokenizer_path, end_id)
    return file_index(spark, folder)
