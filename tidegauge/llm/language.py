"""Language identification: scripts, word scores and Viterbi over the words.

A word is a run of letters. Its script (of its first letter, by ranges of code
points) leaves the languages that were seen to use that script. Its score for a
language is the log-likelihood of its character trigrams, which are counted over
all documents that may be learned from. The best labelling of a text's words pays a
penalty for every switch, so spans of another language show up and single odd words
do not.

Most texts are of one language, which can be proven without walking through them:
if no run of words gains as much as one penalty in any other language, no detour
pays. Only the other texts are walked through word by word.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import learnable, remembered, slices, sums, texts_of

ENTRIES = 1 << 14
SWITCH = 12.0
UNKNOWN = "und"
_SMOOTHING = 0.5
_COMMON_SCRIPT = 0.01
#: First code points of scripts (fixed values, from the Unicode blocks); a script
#: goes on up to the next row.
SCRIPTS = (
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0900, "devanagari"),
    (0x0980, "bengali"),
    (0x0A00, "other indic"),
    (0x0E00, "thai"),
    (0x0E80, "other asian"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "other asian"),
    (0x3400, "han"),
    (0xA000, "other asian"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "other"),
    (0x20000, "han"),
)
SCRIPT_NAMES = tuple(dict.fromkeys(name for _, name in SCRIPTS))


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter, its script, its lower case."""
    size = 0x110000
    letter = np.fromiter(
        (unicodedata.category(chr(c))[0] == "L" for c in range(size)), bool, size
    )
    script = np.zeros(size, np.uint8)
    for first, name in SCRIPTS:
        script[first:] = SCRIPT_NAMES.index(name)
    lower = np.arange(size, dtype=np.uint32)
    for c in np.flatnonzero(letter).tolist():
        small = chr(c).lower()
        if len(small) == 1:
            lower[c] = ord(small)
    return letter, script, lower


@dataclass
class Words:
    """The words of some texts."""

    begins: np.ndarray  # first letter, in characters of all texts together
    ends: np.ndarray
    counts: np.ndarray  # words per text
    scripts: np.ndarray
    trigrams: np.ndarray  # entry of every letter, with its neighbours
    first: np.ndarray  # first letter of every word among all letters
    starts: np.ndarray  # first character of each text


def words_of(texts: list[str]) -> Words:
    """Find the words of texts and the trigrams around their letters."""
    letter, script, lower = remembered("letters", _tables)
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letter[points]
    small = np.where(is_letter, lower[points], np.uint32(0)).astype(np.uint64)
    edge = np.diff(is_letter.astype(np.int8), prepend=0, append=0)
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    places = np.flatnonzero(is_letter)
    with np.errstate(over="ignore"):
        left = np.where(places > 0, small[places - 1], np.uint64(0))
        right = small[np.minimum(places + 1, len(small) - 1)]
        code = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (
            small[places] * np.uint64(0xC2B2AE3D27D4EB4F)
        )
        code = (code ^ (right * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0x9FB21C651E98DF25)
    trigrams = (code >> np.uint64(50)).astype(np.int64)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    counts = np.diff(np.searchsorted(begins, np.cumsum(sizes)), prepend=0)
    scripts = script[points[begins]]
    return Words(begins, ends, counts, scripts, trigrams, np.searchsorted(places, begins), starts)


@dataclass
class Model:
    """Scores per language; languages come with the most learned letters first."""

    languages: list[str]
    table: np.ndarray  # log-likelihood of each trigram entry in each language
    candidates: np.ndarray  # languages of each script

    def word_scores(self, words: Words) -> np.ndarray:
        """Scores of every word, at most zero; languages of other scripts are far below."""
        found = np.add.reduceat(self.table[words.trigrams], words.first, axis=0)
        found = found.astype(np.float64)
        allowed = self.candidates[words.scripts]
        anywhere = allowed.any(axis=1, keepdims=True)
        found = np.where(allowed, found, -1e6)
        found -= found.max(axis=1, keepdims=True)
        # A word in a script that no language uses says nothing.
        return np.where(anywhere, np.maximum(found, -100.0), 0.0)


def viterbi(scores: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The labels with the best sum of scores less the penalties of their switches."""
    rows = scores.tolist()
    n = len(rows[0])
    best = rows[0]
    back = []
    for row in rows[1:]:
        top = max(best)
        source = best.index(top)
        top -= penalty
        back.append([source if top > b else label for label, b in enumerate(best)])
        best = [s + (top if top > b else b) for s, b in zip(row, best, strict=True)]
    label = max(range(n), key=best.__getitem__)
    labels = [label]
    for sources in reversed(back):
        label = sources[label]
        labels.append(label)
    return np.array(labels[::-1])


def labelled(scores: np.ndarray, counts: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The best label of every word of many texts."""
    n_texts, n_labels = len(counts), scores.shape[1]
    owner = np.repeat(np.arange(n_texts), counts)
    totals = np.stack([sums(scores[:, i], counts) for i in range(n_labels)], axis=1)
    best = totals.argmax(axis=1)
    labels = best[owner]
    # Largest gain of a run of words in another language, text by text: sums up to a
    # word less the smallest earlier sum. Texts are set apart by a large step.
    own = scores[np.arange(len(scores)), labels]
    gain = np.zeros(n_texts)
    ends = np.cumsum(counts)
    used = np.flatnonzero(counts)
    places = np.arange(len(scores)) + owner + 1  # each text begins with an empty sum
    for other in range(n_labels):
        extra = scores[:, other] - own
        running = np.cumsum(extra)
        step = 2 * (np.abs(running).max(initial=0) + 1)
        line = np.empty(len(scores) + n_texts)
        before = np.concatenate([[0], running])
        line[ends - counts + np.arange(n_texts)] = before[ends - counts] - step * np.arange(n_texts)
        line[places] = running - step * owner
        rise = line - np.minimum.accumulate(line)
        most = np.maximum.reduceat(rise, ends - counts + np.arange(n_texts))
        gain = np.maximum(gain, most)
    # Beside the base, one run pays for two switches or for one at an end of the text; a
    # path without the base has k runs and k - 1 switches, so that its best run gains more
    # than (k - 1) / k of a penalty. Below half a penalty the base alone is best.
    for text in used[gain[used] >= penalty / 2].tolist():
        part = slice(int(ends[text] - counts[text]), int(ends[text]))
        labels[part] = viterbi(scores[part], penalty)
    return labels


def learned_model(
    documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> Model:
    """Count trigrams and scripts over all documents with a language that may be learned from.

    Tasks count what they see; counts meet by (language, entry). The driver gets the
    model: a fixed number of entries for each language.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            words = words_of(texts_of(batch))
            if not len(words.begins):
                continue
            names = batch.column("lang").to_pylist()
            per_word = np.diff(words.first, append=len(words.trigrams))
            scripts = np.repeat(words.scripts, per_word)
            letters = sums(per_word, words.counts)
            owner = np.repeat(np.arange(len(names)), letters)
            kinds = {name: i for i, name in enumerate(dict.fromkeys(names))}
            kind = np.array([kinds[n] for n in names])[owner]
            width = ENTRIES + len(SCRIPT_NAMES)
            seen = np.bincount(kind * width + words.trigrams, minlength=len(kinds) * width)
            seen += np.bincount(kind * width + ENTRIES + scripts, minlength=len(kinds) * width)
            for name, i in kinds.items():
                own = seen[i * width : (i + 1) * width]
                totals[name] = totals[name] + own if name in totals else own
        for name, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(total[at])],
                names=["lang", "entry", "n"],
            )

    own = documents.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    own = own.where(learnable(F.col("key")) & F.col("lang").isNotNull()).select("text", "lang")
    rows = (
        own.mapInArrow(counted, "lang string, entry long, n long")
        .groupBy("lang", "entry")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    by_lang: dict[str, np.ndarray] = {}
    names = rows.column("lang").to_pylist()
    at, n = rows.column("entry").to_numpy(), rows.column("n").to_numpy()
    place = np.array(names, object)
    for name in set(names):
        total = np.zeros(ENTRIES + len(SCRIPT_NAMES))
        mine = place == name
        total[at[mine]] = n[mine]
        by_lang[name] = total
    order = sorted(by_lang, key=lambda name: (-by_lang[name][:ENTRIES].sum(), name))
    table = np.zeros((ENTRIES, len(order)), np.float32)
    candidates = np.zeros((len(SCRIPT_NAMES), len(order)), bool)
    for i, name in enumerate(order):
        seen, scripts = by_lang[name][:ENTRIES], by_lang[name][ENTRIES:]
        table[:, i] = np.log((seen + _SMOOTHING) / (seen.sum() + _SMOOTHING * ENTRIES))
        candidates[:, i] = scripts >= _COMMON_SCRIPT * scripts.sum()
    return Model(order, table, candidates)


SPANS = "array<struct<begin:int,end:int,lang:string>>"


def languages(
    documents: DataFrame,
    model: Model,
    key: str = "doc_id",
    text: str = "text",
    penalty: float = SWITCH,
) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``spans`` of every whole text.

    Spans are stretches of words of one language, with begin and end in characters.
    The language with the most letters is predicted (of equals, the one with more
    learned letters); the score is its share of all letters. A text that is null or
    has no letter gets ``und``, score 0 and no spans, and so does everything if there
    was nothing to learn from. Rows are independent, so repeated and null ids stay.
    Other columns are ignored.
    """
    numbers = documents.sparkSession.sparkContext.broadcast(vars(model))
    span = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**numbers.value)
        n_labels = len(own.languages)
        for batch in slices(batches):
            words = words_of(texts_of(batch))
            n = batch.num_rows
            if n_labels and len(words.begins):
                labels = labelled(own.word_scores(words), words.counts, penalty)
                owner = np.repeat(np.arange(n), words.counts)
                letters = np.bincount(
                    owner * n_labels + labels,
                    words.ends - words.begins,
                    minlength=n * n_labels,
                ).reshape(n, n_labels)
                total = letters.sum(axis=1)
                best = letters.argmax(axis=1)
                share = np.divide(letters.max(axis=1), total, out=np.zeros(n), where=total > 0)
                changes = np.append(True, (labels[1:] != labels[:-1]) | (owner[1:] != owner[:-1]))
                at = np.flatnonzero(changes)
                last = np.append(at[1:], len(labels)) - 1
                base = words.starts[owner[at]]
                flat = pa.StructArray.from_arrays(
                    [
                        pa.array((words.begins[at] - base).astype(np.int32)),
                        pa.array((words.ends[last] - base).astype(np.int32)),
                        pa.array([own.languages[i] for i in labels[at].tolist()], pa.string()),
                    ],
                    fields=list(span),
                )
                offsets = np.append(0, np.cumsum(np.bincount(owner[at], minlength=n)))
                names = [
                    own.languages[b] if some else UNKNOWN
                    for b, some in zip(best.tolist(), (total > 0).tolist(), strict=True)
                ]
            else:
                flat = pa.array([], span)
                offsets, share, names = np.zeros(n + 1, int), np.zeros(n), [UNKNOWN] * n
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(names, pa.string()),
                    pa.array(share.astype(np.float64)),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                ],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    chosen = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(chosen.dtypes)["doc_id"]
    return chosen.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, spans {SPANS}")
