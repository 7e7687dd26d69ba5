"""Splitting text by the public pattern, and remembering what pieces encode to."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Sequence
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import regex

from tidegauge.llm.common import ranges, remembered, sums

#: The public pattern in the words of the standard library, right but for the odd characters.
_QUICK = re.compile(
    r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
)
#: The same for texts in Latin letters only, whose classes are short lists.
_LATIN_END = 0x250
_LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_BLANKS = r"\t-\r \x85\xa0"
_LATIN = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_BLANKS}{_LETTERS}0-9]+"
    rf"|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)
#: The ASCII characters that the two engines class differently.
_ODD_ASCII = "\x1c\x1d\x1e\x1f"
EXACT = regex.compile(public_tokenizers.PATTERN)
Pattern = re.Pattern | regex.Pattern


def _odd_characters() -> np.ndarray:
    """For each code point, whether the two engines class it differently.

    These are some numbers and separators.
    """
    odd = [
        unicodedata.category(chr(c)) in ("No", "Nl") or 0x1C <= c <= 0x1F for c in range(0x110000)
    ]
    return np.array(odd)


def patterns(texts: Sequence[str]) -> list[Pattern]:
    """For each text, a pattern that splits it just as the public one does."""
    found = [EXACT if any(c in t for c in _ODD_ASCII) else _LATIN for t in texts]
    others = [i for i, t in enumerate(texts) if not t.isascii()]
    points = "".join([texts[i] for i in others]).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(points, "<u4")
    sizes = np.array([len(texts[i]) for i in others], np.int64)
    odd = sums(remembered("odd characters", _odd_characters)[points], sizes) > 0
    wide = sums(points >= _LATIN_END, sizes) > 0
    for i, o, w in zip(others, odd.tolist(), wide.tolist(), strict=True):
        found[i] = EXACT if o else _QUICK if w else _LATIN
    return found


def split(text: str, pattern: Pattern = EXACT) -> list[str]:
    """All matches of a pattern, which together are the text."""
    return pattern.findall(text)


class _Places(dict):
    """Numbers new keys and lists them."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        place = self[piece] = len(self)
        self.new.append(piece)
        return place


class PieceIds:
    """Ids of texts, where each distinct piece is encoded once.

    ``encode`` turns a list of pieces into (all ids, ids per piece). At most about
    ``limit`` pieces are remembered, in two halves: when the newer one is full, the older
    one goes. Pieces that come often thus stay, as they pass from the older to the newer.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        limit: int = 150_000,
    ) -> None:
        self._encode = encode
        self._half = limit // 2
        self._start()
        self._keep()

    def _keep(self) -> None:
        """What is known becomes the older half."""
        self._older = self._places, self._ids, self._starts, self._lengths
        self._start()

    def _start(self) -> None:
        self._places = _Places()
        self._ids = np.zeros(1 << 16, np.uint32)
        self._used = 0
        self._starts = np.zeros(1 << 14, np.uint32)
        self._lengths = np.zeros(1 << 14, np.uint32)

    def _found(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces from the older half, or else encoded."""
        places, older_ids, starts, sizes = self._older
        at = np.fromiter(map(places.get, new, repeat(-1)), np.int64, len(new))
        old, others = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        if not len(old):
            return self._encode(new)
        lengths = np.empty(len(new), np.int64)
        lengths[old] = sizes[at[old]]
        if len(others):
            encoded, lengths[others] = self._encode([new[i] for i in others.tolist()])
        ids = np.empty(lengths.sum(), np.uint32)
        begins = np.cumsum(lengths) - lengths
        ids[ranges(begins[old], lengths[old])] = older_ids[ranges(starts[at[old]], lengths[old])]
        if len(others):
            ids[ranges(begins[others], lengths[others])] = encoded
        return ids, lengths

    def _learn(self) -> None:
        new, self._places.new = self._places.new, []
        if not new:
            return
        ids, lengths = self._found(new)
        first, last = len(self._places) - len(new), len(self._places)
        if last > len(self._starts):
            self._starts = np.resize(self._starts, last + last // 2)
            self._lengths = np.resize(self._lengths, last + last // 2)
        if self._used + len(ids) > len(self._ids):
            self._ids = np.resize(self._ids, 3 * (self._used + len(ids)) // 2)
        self._ids[self._used : self._used + len(ids)] = ids
        self._lengths[first:last] = lengths
        self._starts[first:last] = self._used + np.cumsum(lengths) - lengths
        self._used += len(ids)

    def __call__(self, texts: Sequence[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts given as pieces, and the number of ids of each text."""
        if len(self._places) > self._half:
            self._keep()
        counts = np.array([len(p) for p in texts], np.int64)
        places = np.fromiter(
            map(self._places.__getitem__, chain.from_iterable(texts)), np.int64, counts.sum()
        )
        self._learn()
        lengths = self._lengths[places].astype(np.int64)
        return self._ids[ranges(self._starts[places], lengths)], sums(lengths, counts)
