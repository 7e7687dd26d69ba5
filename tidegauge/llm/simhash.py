"""SimHash near-duplicates through an inverted index on byte positions.

A fingerprint has eight bytes. Two fingerprints that differ in at most three bits
share at least five of them in place, which is the count that filters pairs. Lists
for single bytes would hold a 256th of all fingerprints each, so the index keys are
sets of four positional bytes. The 14 sets are the planes of the affine space of
eight points: four positions whose numbers add up to zero without carry. Any three
positions lie in exactly one plane and the other four positions are a plane too, so
two fingerprints that differ in at most three bytes meet in at least one list.

Pairs that meet have their shared bytes tallied; those with five or more are
verified by their bit distance. Within a list the links are followed from
fingerprint to fingerprint, and only one link per fingerprint leaves a task: to the
smallest one that can be reached there. A list that is too long for a task is cut
into parts, and every two parts meet in a task of their own. Components come from
passing on the smallest document id along the links, with jumps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import shuffle_partitions, slices, text_mark
from tidegauge.plans.shared import files_for, in_fewer_tasks, stored

WORDS = 3
DISTANCE = 3
LIST_SIZE = 8192
_SEED = 42
_BYTES = 8
_NO_ID = 2**63 - 1


def _planes() -> list[int]:
    """Masks of the 14 planes: four positions a, b, c and a ^ b ^ c each."""
    sets = {
        frozenset((a, b, c, a ^ b ^ c))
        for a in range(_BYTES)
        for b in range(a)
        for c in range(b)
    }
    return sorted(sum(0xFF << (8 * p) for p in s) for s in sets)


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def shingle_hashes(text: bytes, words: int = WORDS) -> list[int]:
    """XXH64 of every run of ``words`` words (of all words, if there are fewer)."""
    found = text.lower().split()  # both act on ASCII only
    if not found:
        return []
    joined = b" ".join(found)
    size = min(words, len(found))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    begins = np.append(0, ends[:-1] + 1)
    digest = xxhash.xxh64_intdigest
    return [
        digest(joined[b:e], _SEED)
        for b, e in zip(begins[: len(found) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    ]


def simhash_of(texts: list[bytes], words: int = WORDS) -> np.ndarray:
    """Fingerprints: a bit is set if it is set in more than half of the hashes."""
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        hashes = np.array(shingle_hashes(text, words), "<u8")
        if len(hashes):
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, _BYTES), axis=1, bitorder="little")
            set_bits = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
            out[i] = np.packbits(set_bits, bitorder="little").view("<u8")[0]
    return out


def fingerprints(
    documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS
) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text) and ``fingerprint`` (long) of every whole text.

    A null text, or one without words, has fingerprint zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            prints = simhash_of(texts, words).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(prints)],
                names=["doc_id", "mark", "fingerprint"],
            )

    chosen = documents.select(
        F.col(key).cast("long").alias("doc_id"),
        text_mark(F.col(text)).alias("mark"),
        F.col(text).alias("text"),
    )
    return chosen.mapInArrow(run, "doc_id long, mark long, fingerprint long")


def _reached(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint linked to another one here, the smallest it is connected to."""
    prints = np.unique(prints)
    waiting = prints
    linked, roots = [], []
    needed = _BYTES - distance
    while len(waiting) > 1:
        root, waiting = waiting[0], waiting[1:]
        front = [root]
        while front and len(waiting):
            different = waiting ^ front.pop()
            shared = (different.view(np.uint8).reshape(-1, _BYTES) == 0).sum(axis=1)
            near = np.flatnonzero(shared >= needed)
            near = near[np.bitwise_count(different[near]) <= distance]
            if len(near):
                found = waiting[near]
                linked.append(found)
                roots.append(np.full(len(found), root))
                front.extend(found)
                waiting = np.delete(waiting, near)
    if not linked:
        return prints[:0], prints[:0]
    return np.concatenate(linked), np.concatenate(roots)


def _list_links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links within lists; rows come sorted by list, which may go over several batches."""

    def links(lists: np.ndarray, prints: np.ndarray) -> pa.RecordBatch | None:
        begins = np.flatnonzero(np.append(True, (lists[1:] != lists[:-1]).any(axis=1)))
        ends = np.append(begins[1:], len(lists))
        several = ends - begins > 1
        found = [
            _reached(prints[b:e], distance)
            for b, e in zip(begins[several].tolist(), ends[several].tolist(), strict=True)
        ]
        found = [f for f in found if len(f[0])]
        if not found:
            return None
        a, b = (np.concatenate(c).view(np.int64) for c in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    lists, prints = np.zeros((0, 4), np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("plane", "part", "i", "j")]
        lists = np.concatenate([lists, np.stack([c.astype(np.int64) for c in columns], axis=1)])
        own = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
        prints = np.concatenate([prints, own])
        # The last list may go on.
        changes = np.flatnonzero((lists[1:] != lists[:-1]).any(axis=1))
        if len(changes):
            cut = int(changes[-1]) + 1
            out = links(lists[:cut], prints[:cut])
            if out is not None:
                yield out
            lists, prints = lists[cut:], prints[cut:]
    if len(lists):
        out = links(lists, prints)
        if out is not None:
            yield out


def links(prints: DataFrame, distance: int = DISTANCE, list_size: int = LIST_SIZE) -> DataFrame:
    """Links (``a``, ``b``) that connect distinct fingerprints just as all close pairs do.

    ``prints`` has a column ``print`` of distinct values. Distances up to three are
    covered, by the choice of lists.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError("the lists find distances of at most three bits")
    keys = F.array(
        *[
            F.struct(
                F.lit(i).alias("plane"),
                F.col("print").bitwiseAND(F.lit(_signed(mask))).alias("part"),
            )
            for i, mask in enumerate(_planes())
        ]
    )
    postings = prints.select("print", F.explode(keys).alias("k")).select("k.plane", "k.part", "print")
    sizes = postings.groupBy("plane", "part").agg(F.count(F.lit(1)).alias("size"))
    long_lists = stored(sizes.where(F.col("size") > list_size))
    if long_lists.isEmpty():
        dealt = postings.select("plane", "part", F.lit(0).alias("i"), F.lit(0).alias("j"), "print")
    else:
        # A part pairs with itself and with every other part.
        parts = F.coalesce(F.ceil(F.col("size") * 2 / list_size).cast("int"), F.lit(1))
        own = F.pmod(F.xxhash64("print"), F.col("parts")).cast("int")
        pair = F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda other: F.struct(
                F.least(F.col("own"), other).alias("i"), F.greatest(F.col("own"), other).alias("j")
            ),
        )
        dealt = (
            postings.join(long_lists, ["plane", "part"], "left")
            .withColumn("parts", parts)
            .withColumn("own", own)
            .select("plane", "part", "print", F.explode(pair).alias("p"))
            .select("plane", "part", "p.i", "p.j", "print")
        )
    lists = ["plane", "part", "i", "j"]
    n = shuffle_partitions(prints.sparkSession)
    return (
        dealt.repartition(n, *lists)
        .sortWithinPartitions(*lists)
        .mapInArrow(lambda batches: _list_links(batches, distance), "a long, b long")
        .distinct()
    )


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``print`` and ``root`` (its component's smallest ``label``) of nodes that have links.

    ``nodes`` has ``print`` and ``label`` (of any type that has an order), ``edges`` has
    ``a`` and ``b``. Each round
    passes the smallest root along the links and then takes the root of the root,
    so chains shrink by half; every round is written to the shared folder. Both tables are
    read more than once, so they should be stored.
    """
    ends_of_links = 2 * edges.count()
    files = files_for(ends_of_links)
    both = stored(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        files,
    )
    ends = both.select(F.col("a").alias("print")).distinct()
    start = F.struct("label", F.col("print").alias("at"))
    state = stored(
        nodes.join(ends, "print", "left_semi").select("print", start.alias("root")),
        files_for(nodes.count() + ends_of_links),
    )
    while True:
        sent = (
            both.join(state, F.col("a") == F.col("print"))
            .groupBy("b")
            .agg(F.min("root").alias("heard"))
        )
        heard = stored(
            state.join(sent, F.col("print") == F.col("b"), "left").select(
                "print",
                F.least("root", F.coalesce("heard", "root")).alias("root"),
                F.col("root").alias("old"),
            ),
            files,
        )
        ahead = heard.select(F.col("print").alias("at"), F.col("root").alias("ahead"))
        state = stored(
            heard.join(ahead, F.col("root.at") == F.col("at")).select(
                "print",
                F.least("root", "ahead").alias("root"),
                (F.least("root", "ahead") < F.col("old")).alias("moved"),
            ),
            files,
        )
        if state.where("moved").isEmpty():
            return state.select("print", F.col("root.label").alias("root"))
        state = state.drop("moved")


def _rooted(prints: DataFrame, distance: int) -> DataFrame:
    """``print`` and ``root``: id and mark of the first row of the component, by id, then mark.

    ``prints`` is a stored table.
    """
    files = files_for(prints.count())
    row = F.struct(F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "mark")
    nodes = stored(
        prints.groupBy(F.col("fingerprint").alias("print")).agg(F.min(row).alias("label")), files
    )
    roots = components(nodes, stored(links(nodes.select("print"), distance), files))
    return stored(
        nodes.join(roots, "print", "left").select("print", F.coalesce("root", "label").alias("root")),
        files,
    )


def near_duplicates(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    distance: int = DISTANCE,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every document.

    The component is named by the smallest id reachable over fingerprints that
    differ in at most ``distance`` bits. Texts without words, null ones among them,
    have fingerprint zero and are linked like any other. Rows with equal ids stay
    separate rows; a null id names no component, unless it has no other. Empty
    tables give no rows; other columns are ignored.
    """
    prints = stored(fingerprints(documents, key, text, words))
    rooted = _rooted(prints, distance)
    return prints.join(rooted, F.col("fingerprint") == F.col("print")).select(
        "doc_id",
        _hex(F.col("fingerprint")).alias("fingerprint"),
        F.nullif(F.col("root.id"), F.lit(_NO_ID)).alias("component_id"),
    )


def _hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def one_per_group(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    distance: int = DISTANCE,
) -> DataFrame:
    """The documents without near-duplicates: of each group the row with the smallest id.

    Null ids come last; where ids are equal or missing, a hash of the text decides, and
    of rows with equal id and text any one stays. So every group keeps exactly one
    row. All columns are kept. Empty tables give no rows.
    """
    prints = stored(fingerprints(documents, key, text, words))
    rows = prints.count()
    kept = stored(_rooted(prints, distance).select("root.*").distinct(), files_for(rows))
    row = [F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "mark"]
    copies = prints.select(*row).groupBy("id", "mark").agg(F.count(F.lit(1)).alias("n"))
    several = stored(kept.join(copies.where("n > 1"), ["id", "mark"], "left_semi"))
    names = documents.columns
    lower = [n.lower() for n in names]
    inner = documents.toDF(*[f"c{i}" for i in range(len(names))])
    marked = inner.withColumns(
        {
            "own_id": F.coalesce(F.col(f"c{lower.index(key.lower())}").cast("long"), F.lit(_NO_ID)),
            "own_mark": text_mark(F.col(f"c{lower.index(text.lower())}")),
        }
    )
    own = ["own_id", "own_mark"]

    def rows_of(chosen: DataFrame) -> DataFrame:
        return marked.join(chosen.toDF(*own), own, "left_semi").select(*marked.columns)

    # Whole texts need not meet, but for rows with equal id and text.
    if several.isEmpty():
        staying = rows_of(kept)
    else:
        once = rows_of(kept.join(several, ["id", "mark"], "left_anti"))
        staying = once.unionByName(rows_of(several).dropDuplicates(own))
    return in_fewer_tasks(staying.drop(*own).toDF(*names), rows)
