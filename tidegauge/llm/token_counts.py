"""Token counts of every prefix, by dynamic programming over the prefixes of a text.

For merges in the order of fixed scores, two neighbouring pieces stay apart in any
text if they stay apart on their own.  So the encoding of a prefix ends in the one
piece that is whole by itself and stays apart from the last piece of what stands
before it, and

    count(prefix) = count(prefix without that piece) + tokens of that piece.

One pass from left to right thus gives the exact count of every prefix.  Texts are cut
where no piece of the vocabulary can cross, which makes the passes short, and equal
units are counted once per memory of units.

What is stored of a text is the change from each prefix to the next, a byte per code
point, and the count at every 1024th: the count of any prefix, and the longest prefix
within a budget, are read from that without encoding anything again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import remembered, slices, texts_of

LIMIT = 4096
#: Code points between two stored counts.
STEP = 1024
_UNITS_KEPT = 1_000_000
_PAIRS_KEPT = 500_000
_NEVER = 1 << 60
# No piece has a blank behind another character, or a line feed next to one.
_UNIT = re.compile(r" *[^ \n]+| +|\n")


class Pieces:
    """The pieces of a sentencepiece BPE model with byte fallback, blanks as ' '."""

    def __init__(self, model: bytes) -> None:
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        if library.normalize("  ﬁ\t½ é ") != "▁" + "  ﬁ\t½ é ".replace(" ", "▁"):
            raise ValueError("only models that leave texts as they are can be counted")
        scores = {
            library.id_to_piece(i).replace("▁", " "): library.get_score(i)
            for i in range(library.get_piece_size())
            if not (library.is_unknown(i) or library.is_control(i) or library.is_byte(i))
        }
        # Equal scores are one rank: the leftmost of them is merged first.
        ranks = {s: i for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {piece: ranks[score] for piece, score in scores.items()}
        #: Per piece that merging gives whole: its parts and their parts along both edges.
        self.right: dict[str, list[tuple[str, int, int]]] = {}
        self.left: dict[str, list[tuple[str, int, int]]] = {}
        halves: dict[str, tuple[str, str]] = {}
        for piece in self.rank:
            if len(piece) > 1:
                parts, last = self._merged(piece)
                if len(parts) == 1:
                    halves[piece] = last
        self.halves = halves
        self.cuts = not any(
            "\n" in p and len(p) > 1 or re.search(r"[^ ] ", p) for p in self.rank
        )
        self.names = [*halves, *(p for p in self.rank if len(p) == 1)]
        self.numbers = {piece: i for i, piece in enumerate(self.names)}
        self.sizes = [len(p) for p in self.names]
        self.cost = [1] * len(self.names)
        self.ending = ahocorasick.Automaton()
        for number, piece in enumerate(self.names):
            self.ending.add_word(piece, number)
        self.ending.make_automaton()
        self.units: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str]]:
        """The pieces of a short text, best score first, and the last merge."""
        parts, last = list(text), ("", "")
        while True:
            ranks = [
                (self.rank.get(a + b, _NEVER), i)
                for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
            ]
            best, i = min(ranks, default=(_NEVER, 0))
            if best == _NEVER:
                return parts, last
            last = (parts[i], parts[i + 1])
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _edge(self, piece: str, side: int) -> list[tuple[str, int, int]]:
        """The parts at one edge of a piece, smallest first, with the times they live.

        Times are ranks: a part lives from its own merge until the next one takes it,
        and a merge that becomes possible late happens at once.
        """
        known = (self.left, self.right)[side]
        if piece not in known:
            chain = [piece]
            while chain[-1] in self.halves:
                chain.append(self.halves[chain[-1]][side])
            chain.reverse()
            born, births = -1, []
            for part in chain:
                born = max(born, self.rank[part] if len(part) > 1 else -1)
                births.append(born)
            known[piece] = list(zip(chain, births, [*births[1:], _NEVER], strict=True))
        return known[piece]

    def apart(self, left: str, right: str) -> bool:
        """Whether two whole pieces stay apart: no merge ever takes a part of each."""
        for a, a_from, a_until in self._edge(left, 1):
            for b, b_from, b_until in self._edge(right, 0):
                rank = self.rank.get(a + b)
                if rank is None:
                    continue
                at = max(rank, a_from, b_from)
                # Of equal ranks the left merge is first.
                if at < a_until and at <= b_until:
                    return False
        return True

    def _number(self, char: str) -> int:
        """The number of a code point that is no piece; it takes its bytes as tokens."""
        number = self.numbers.get(char)
        if number is None:
            number = self.numbers[char] = len(self.names)
            self.names.append(char)
            self.sizes.append(1)
            self.cost.append(len(char.encode()))
        return number

    def _fits(self, before: int, piece: int) -> bool:
        """Whether two pieces stay apart, remembered."""
        pair = before << 24 | piece
        fits = self.pairs.get(pair)
        if fits is None:
            if len(self.pairs) >= _PAIRS_KEPT:
                self.pairs.clear()
            fits = self.pairs[pair] = self.apart(self.names[before], self.names[piece])
        return fits

    def _counted(self, unit: str) -> list[int]:
        """Counts of all prefixes of a unit, the empty one first."""
        counts, lasts, done = [0], [0], 0
        sizes, cost, fits, known = self.sizes, self.cost, self._fits, self.pairs.get
        # All pieces that end at a place, place by place, the longest first.
        for at, piece in self.ending.iter(unit):
            while done < at:
                done = self._odd(unit, done, counts, lasts)
            if done > at:
                continue
            start = at + 1 - sizes[piece]
            before = lasts[start]
            if start:
                stays = known(before << 24 | piece)
                if not (fits(before, piece) if stays is None else stays):
                    continue
            counts.append(counts[start] + cost[piece])
            lasts.append(piece)
            done = at + 1
        while done < len(unit):
            done = self._odd(unit, done, counts, lasts)
        return counts

    def _odd(self, unit: str, at: int, counts: list[int], lasts: list[int]) -> int:
        """Count a code point at which no piece ends: it is its own bytes."""
        if unit[at] in self.rank:
            raise ValueError(f"no piece ends at {at} of {unit[:100]!r}")
        piece = self._number(unit[at])
        counts.append(counts[at] + self.cost[piece])
        lasts.append(piece)
        return at + 1

    def _changes(self, unit: str) -> bytes | None:
        """The changes from each prefix of a unit to the next, if each fits a byte."""
        counts = self._counted(unit)
        try:
            changes = bytes([128 + b - a for a, b in pairwise(counts)])
        except ValueError:
            return None
        if len(unit) <= 64:
            if len(self.units) >= _UNITS_KEPT:
                self.units.clear()
            self.units[unit] = changes
        return changes

    def prefixes(self, text: str) -> np.ndarray:
        """Number of tokens of every prefix of ``text``, the empty one first."""
        if not text:
            return np.zeros(1, np.int64)
        # The library puts one blank in front, which the first prefix has already.
        padded = " " + text.replace("▁", " ")
        units = _UNIT.findall(padded) if self.cuts else [padded]
        known = self.units.get
        changes = [known(u) or self._changes(u) for u in units]
        if None in changes:
            steps = np.concatenate([np.diff(self._counted(u)) for u in units])
        else:
            steps = np.frombuffer(b"".join(changes), np.uint8).astype(np.int64) - 128
        counts = np.cumsum(steps, dtype=np.int64)
        counts[0] = 0
        return counts

    def total(self, text: str) -> int:
        """Number of tokens of a text."""
        return int(self.prefixes(text)[-1])


def stored_form(counts: np.ndarray) -> tuple[int, bytes, bytes]:
    """Bytes per change, the changes, and the count at every ``STEP``-th prefix."""
    changes = np.diff(counts)
    small = not len(changes) or (changes.min() >= -128 and changes.max() <= 127)
    return (
        1 if small else 4,
        changes.astype("<i1" if small else "<i4").tobytes(),
        counts[::STEP].astype("<i8").tobytes(),
    )


def prefix_count(width: int, changes: bytes, marks: bytes, length: int) -> int:
    """Tokens of the first ``length`` code points (all, if there are fewer)."""
    length = min(max(length, 0), len(changes) // width)
    block = length // STEP
    near = np.frombuffer(
        changes, f"<i{width}", length - block * STEP, offset=block * STEP * width
    )
    return int(np.frombuffer(marks, "<i8", 1, offset=8 * block)[0]) + int(near.sum(dtype=np.int64))


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix that has at most ``budget`` tokens."""
    fitting = np.flatnonzero(counts <= budget)
    return int(fitting[-1]) if len(fitting) else 0


def all_counts(width: int, changes: bytes) -> np.ndarray:
    """The counts of all prefixes, the empty one first, out of the stored changes."""
    steps = np.frombuffer(changes, f"<i{width}")
    return np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])


def _pieces(model: str) -> Pieces:
    def read() -> Pieces:
        with open(model, "rb") as file:
            return Pieces(file.read())

    return remembered(("token_counts", model), read)


_ADDED = {
    "n_bytes": ("bigint", pa.int64()),
    "n_tokens": ("bigint", pa.int64()),
    "fitting_chars": ("bigint", pa.int64()),
    "width": ("int", pa.int32()),
    "changes": ("binary", pa.binary()),
    "marks": ("binary", pa.binary()),
}
_PREFIXES = ("width", "changes", "marks")


def counted(
    documents: DataFrame,
    model: str,
    text: str = "text",
    budget: int = LIMIT,
    prefixes: bool = True,
) -> DataFrame:
    """Every document with its exact numbers of tokens, for itself and all its prefixes.

    Added are ``n_bytes`` (UTF-8), ``n_tokens``, ``fitting_chars`` (code points of the
    longest prefix with at most ``budget`` tokens) and, with ``prefixes``, the stored
    form of all prefix counts (``width``, ``changes``, ``marks``), which ``tokens_before``
    and ``cut_to_budget`` read.  They replace columns of these names, whatever their case;
    all other columns stay.  ``model`` is the path of a sentencepiece BPE model with byte
    fallback, the same on all executors.  A null or empty text has no tokens; rows,
    repeated ones too, are counted one by one; an empty table gives no rows.  No text is
    cut short: memory is that of one text and 8 bytes per code point.
    """
    own = {n.lower(): n for n in documents.columns}
    added = [n for n in _ADDED if prefixes or n not in _PREFIXES]
    kept = [n for n in documents.columns if n.lower() not in added]
    place = {n: f"c{i}" for i, n in enumerate(kept)}
    read = documents.select(
        *[F.col(f"`{n}`").alias(p) for n, p in place.items()],
        F.col(f"`{own[text.lower()]}`").alias("counted_text"),
    )
    fields = [f"{p} {t}" for p, t in read.dtypes if p != "counted_text"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for batch in slices(batches, "counted_text"):
            rows = []
            for one in texts_of(batch, "counted_text"):
                counts = pieces.prefixes(one)
                row = [len(one.encode()), int(counts[-1]), longest_prefix(counts, budget)]
                rows.append([*row, *stored_form(counts)] if prefixes else row)
            columns = [
                pa.array(list(c), _ADDED[n][1])
                for n, c in zip(added, zip(*rows, strict=True), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], *added]
            )

    schema = ", ".join([*fields, *[f"{n} {_ADDED[n][0]}" for n in added]])
    return read.mapInArrow(count, schema).toDF(*kept, *added)


def tokens_before(documents: DataFrame, length: str, out: str = "tokens_before") -> DataFrame:
    """Counted documents with the tokens of their first so many code points; null for null.

    ``length`` names a column; at most ``STEP`` changes of a row are read.
    """
    names = documents.columns

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [batch.column(c).to_pylist() for c in (*_PREFIXES, length)]
            found = [
                None if wanted is None else prefix_count(width, changes, marks, wanted)
                for width, changes, marks, wanted in zip(*cells, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int64())], names=[*names, out]
            )

    fields = ", ".join(f"`{n}` {t}" for n, t in documents.dtypes)
    return documents.mapInArrow(read, f"{fields}, `{out}` bigint")


def cut_to_budget(documents: DataFrame, budget: int, text: str = "text") -> DataFrame:
    """Counted documents whose texts are cut to the longest prefix within ``budget`` tokens.

    Works on the stored counts alone; ``kept_tokens`` is the number the cut text has.
    """
    names = documents.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers = [], []
            cells = (batch.column(c).to_pylist() for c in (text, "width", "changes"))
            for one, width, changes in zip(*cells, strict=True):
                counts = all_counts(width, changes)
                length = longest_prefix(counts, budget)
                texts.append(None if one is None else one[:length])
                numbers.append(int(counts[length]))
            columns = list(batch.columns)
            columns[names.index(text)] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(numbers, pa.int64())], names=[*names, "kept_tokens"]
            )

    fields = ", ".join(f"`{n}` {t}" for n, t in documents.dtypes)
    return documents.mapInArrow(cut, f"{fields}, kept_tokens bigint")
