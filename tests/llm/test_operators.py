"""The operators against plain Python over whole tables, and their odd cases."""

import base64
import hashlib
import random
import re
import sys
import textwrap
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import FOLDER
from tidegauge.llm import (
    bpe,
    fingerprints,
    language,
    licenses,
    line_dedup,
    mixing,
    pieces,
    quality,
    queries,
    simhash,
    token_files,
    topk,
)
from tidegauge.llm.common import remembered
from tidegauge.plans import shared
from tidegauge.plans.shared import files_for, in_fewer_tasks, stored


def pairs(frame):
    return [(r["doc_id"], r["text"] or "") for r in frame.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(queries.TOKENIZER)
    found.encode_special_tokens = True
    return found


@pytest.fixture(scope="module")
def ranks():
    lines = open(queries.RANKS, "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


# 1: token files


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
@pytest.mark.parametrize("high", [1, 2, 50257, 2**21, 2**32])
def test_words_round_trip(n, high):
    ids = np.random.default_rng(n).integers(0, high, n).astype(np.uint32)
    ids[::3] //= 91
    words, first = token_files.pack(ids)
    assert (token_files.unpack(words, first, n) == ids).all()
    block = token_files.block_bytes(ids, np.array([n]))
    assert token_files.read_block(block)[0].tolist() == ids.tolist()


@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
def test_token_files(request, name, tokenizer):
    frame = request.getfixturevalue(name)
    rows = sorted(pairs(frame), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    expected, start = [], 0
    for key, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        expected.append((key, start, len(ids), crc))
        start += len(ids)
    got = token_files.token_index(frame, queries.TOKENIZER, 2).collect()
    order = sorted((tuple(r) for r in got), key=lambda r: r[1])
    assert order == expected


def test_strings_of_added_tokens_are_these_tokens(spark):
    plain = Tokenizer.from_file(queries.TOKENIZER)
    end = "<|endoftext|>"
    texts = [f"a{end}b", "no such string", f"  {end}{end} x\n", "", end[:-1], f"wörter {end}", "tail"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    expected, start = [], 0
    for key, text in enumerate(texts):
        ids = [*plain.encode(text, add_special_tokens=False).ids, 2]
        expected.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert expected[0][2] == 4
    got = token_files.token_index(frame, queries.TOKENIZER, 2).collect()
    assert sorted(tuple(r) for r in got) == expected


def test_pieces_that_come_often_are_encoded_once():
    asked = []

    def encode(new):
        asked.extend(new)
        ids = np.array([ord(c) for p in new for c in p], np.uint32)
        return ids, np.array([len(p) for p in new], np.int64)

    known = pieces.PieceIds(encode, limit=40)
    for i in range(200):
        texts = [["often", f"rare{i}", "often"], [], ["", f"once{i}"]]
        ids, lengths = known(texts)
        assert "".join(map(chr, ids)) == "".join(p for t in texts for p in t)
        assert lengths.tolist() == [sum(map(len, t)) for t in texts]
    assert Counter(asked).most_common(1)[0][1] == 1


def test_patterns_of_odd_characters():
    rng = random.Random(2)
    alphabet = "ab 1'\n\x1c\x1f\x85²é\u2003ƒǅ中Ⅷ .s"
    texts = ["".join(rng.choices(alphabet[: rng.randrange(2, 21)], k=rng.randrange(30))) for _ in range(2000)]
    for text, pattern in zip(texts, pieces.patterns(texts), strict=True):
        assert pieces.split(text, pattern) == pieces.split(text)


# 2: top k


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 8).tolist(), i % 7 == 0) for i in range(1500)]
    rows += [(i, rows[i % 5][1], False) for i in range(1500, 1600)]  # ties
    rows += [(2000, None, True), (2001, [None] * 8, True), (2002, [float("nan")] * 8, True)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score boolean")
    got = defaultdict(list)
    for r in topk.top_k(frame, F.col("score"), k=10).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    weights = np.floor(1024 * np.array([r[1] for r in rows[:1600]])).astype(int)
    assert set(got) == {r[0] for r in rows[:1600] if r[2]}
    for key, found in got.items():
        scores = weights @ weights[key]
        best = sorted((-s, i) for i, s in enumerate(scores.tolist()) if i != key)[:10]
        assert sorted(found) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]


def test_top_k_of_large_shards():
    rng = np.random.default_rng(4)
    weights = np.floor(1024 * rng.normal(0, 0.1, (4000, 16))).astype(np.int64)
    shard = topk.Shard(np.arange(4000), weights)
    for key in range(0, 4000, 400):
        ids, scores = shard.search(key, weights[key], 10)
        all_scores = weights @ weights[key]
        best = sorted((-s, i) for i, s in enumerate(all_scores.tolist()) if i != key)[:10]
        assert [(-s, i) for i, s in zip(ids.tolist(), scores.tolist(), strict=True)] == best


@pytest.mark.parametrize("n_dims", range(1, 13))
def test_top_k_of_few_dimensions(n_dims):
    weights = np.random.default_rng(n_dims).integers(-900, 900, (3000, n_dims))
    shard = topk.Shard(np.arange(3000), weights)
    for key in range(0, 3000, 150):
        ids, scores = shard.search(key, weights[key], 10)
        every = (weights @ weights[key]).tolist()
        best = sorted((-s, i) for i, s in enumerate(every) if i != key)[:10]
        assert [(-s, i) for i, s in zip(ids.tolist(), scores.tolist(), strict=True)] == best


def test_top_k_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 50)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    monkeypatch.setattr(topk, "GROUP_BLOCKS", 2)
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 0.3, 3 + i % 2).tolist()) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = {}
    for r in topk.top_k(frame, F.col("vec_id") % 4 == 0, k=3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    weights = {i: np.floor(1024 * np.float32(v).astype(float)).astype(int) for i, v in rows}
    assert len(got) == 100
    for key, found in got.items():
        every = [(-int(weights[key] @ w), i) for i, w in weights.items() if i != key and len(w) == len(weights[key])]
        assert sorted(found) == [(n + 1, i, -s) for n, (s, i) in enumerate(sorted(every)[:3])]


def test_top_k_without_rows(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(frame, F.col("vec_id") % 100 == 0).count() == 0


# 3: BPE


@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
def test_bpe_equals_the_library(request, name, ranks):
    frame = request.getfixturevalue(name)
    expected = []
    for key, text in pairs(frame):
        ids = ranks.encode_ordinary(text)
        sha = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.append((key, len(ids), sha, hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in bpe.encoding_digests(frame, queries.RANKS).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_joins_of_any_texts(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "LEAF_CHARACTERS", 4)
    codec = bpe.Codec(open(queries.RANKS, "rb").read())
    parts = ["a", "the", "'", "'re", " ", "  ", "\n", "é", "½", "_", "\x1c", "日", "1", "!", "ll"]
    rng = random.Random(1)
    texts = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(1500)]
    texts += ["a" * 3000, "the" * 900, " " * 700 + "x", "\n" * 500, "".join(rng.choices("aeint", k=4000))]
    ids, lengths = codec.encode(texts)
    assert ids.tolist() == [i for t in texts for i in ranks.encode_ordinary(t)]
    assert [bytes(b).decode() for b in codec.decode(ids, lengths)] == texts


def test_runs_of_one_character(ranks):
    encoder = bpe.Codec(open(queries.RANKS, "rb").read()).encoder
    for character in "=-._*#/0":
        for n in range(2, 401):
            run = character * n
            assert list(encoder.piece(run.encode())) == ranks.encode_ordinary(run), (character, n)


def test_merges_with_a_heap(ranks):
    encoder = bpe.Codec(open(queries.RANKS, "rb").read()).encoder
    rng = random.Random(6)
    for letters in ("=-", "aeint", "._", "=", "ab cé日"):
        for _ in range(300):
            data = "".join(rng.choices(letters, k=rng.randrange(1, 90))).encode()
            assert encoder.merged_by_heap(data) == encoder.merged(data)


def test_decoding_columns(documents):
    back = bpe.decoded(bpe.encoded(documents, queries.RANKS), queries.RANKS)
    assert sorted((r[0], bytes(r[1]).decode()) for r in back.collect()) == sorted(pairs(documents))


# 4: fingerprints


@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
def test_edits(request, name):
    frame = request.getfixturevalue(name)
    rows = sorted(pairs(frame), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expected = []
    for i, (key, text) in enumerate(rows):
        n = len(text) // 3
        edited = text[: len(text) - n] + rows[(i + 1) % len(rows)][1][:n]
        expected.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    got = fingerprints.edit_report(frame).collect()
    assert sorted((tuple(r)[:3] for r in got), key=str) == sorted(expected, key=str)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    if name == "documents":
        ordinary = [r for r in got if r["n_chars"] > 300]
        assert np.mean([r["near_edited"] > r["near_next"] + 0.1 for r in ordinary]) > 0.97


def test_equal_substrings_share_names():
    text = "".join(random.Random(2).choices("abcdefghij klm", k=3000))
    names = [set(level[0].tolist()) for level in fingerprints.parse([text])]
    for shift in (1, 7, 100):
        moved = fingerprints.parse(["x" * shift + "?" + text])
        for own, (other, _) in zip(names, moved, strict=True):
            assert len(own & set(other.tolist())) > 0.9 * len(own)
    a, b = fingerprints.sketches([text, text])
    assert a == b and fingerprints.compare(a.fingerprint, b.fingerprint) == 1


# 5: quality


def test_quality_on_rows_kept_for_testing(spark):
    folder = FOLDER.replace("0.001", "0.01")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op5_quality(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    kept = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == y for p, y in kept]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_odd_cases(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (6, 0), (None, 1), (7, None)], "doc_id long, quality int")
    for frame in (odd_documents, no_documents):
        model = quality.trained_model(frame, labels)
        assert quality.scores(frame, model).count() == frame.count()
        assert quality.accepted(frame, model).columns == frame.columns
    blank = quality.trained_model(no_documents, labels.where("false"))
    assert {r["score"] for r in quality.scores(odd_documents, blank).collect()} == {0.5}


def test_quality_takes_one_example_of_an_id(spark):
    rows = [(i, f"word{i} and some more words") for i in range(30)] + [(1, f"text {i}") for i in range(500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    # With one kind of label the score is its share; 500 copies of an id do not outweigh it.
    ones = labels.where("doc_id IN (0, 1, 3, 4)").withColumn("quality", F.lit(1))
    assert quality.trained_model(frame, ones).prior == 1.0
    first, second = (quality.trained_model(f, labels) for f in (frame, frame.repartition(5)))
    assert all(np.allclose(a, b) for a, b in zip(first.weights, second.weights, strict=True))


# 6: mixing


def mixing_targets(sizes):
    """Targets by repeated sharing."""
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, open_sources, aims = 1.5 * sum(sizes.values()), set(sizes), dict.fromkeys(sizes, 0.0)
    while open_sources:
        unit = left / sum(weights[s] for s in open_sources)
        full = {s for s in open_sources if unit * weights[s] > 2 * sizes[s]}
        if not full:
            return aims | {s: unit * weights[s] for s in open_sources}
        aims |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_sources -= full
    return aims


@pytest.mark.parametrize("name", ["documents", "odd_documents"])
def test_mix(request, name):
    frame = request.getfixturevalue(name)
    rows = frame.select("doc_id", "text", "source").collect()
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    sizes, largest = Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += size(r["text"])
        largest[r["source"]] = max(largest[r["source"]], size(r["text"]))
    aims = mixing_targets(sizes)
    got = mixing.mix_report(frame).collect()
    expected = sorted((str(r["doc_id"]), size(r["text"]), sizes[r["source"]]) for r in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["source_size"]) for r in got) == expected
    assert sorted({round(r["target"], 4) for r in got}) == sorted({round(a, 4) for a in aims.values()})
    assert all(r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] for r in got)
    of = {str(r["doc_id"]): r["source"] for r in rows}
    taken = Counter()
    for r in got:
        taken[of[str(r["doc_id"])]] += r["taken"]
    for source, aim in aims.items():
        assert abs(taken[source] - aim) <= largest[source]
    again = mixing.mix_report(frame.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_rows(odd_documents, no_documents):
    copies = Counter()
    for r in mixing.mix_report(odd_documents).collect():
        copies[r["doc_id"]] += r["copies"]
    mixed = mixing.mixed(odd_documents)
    assert mixed.columns == odd_documents.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == +copies
    assert mixing.mixed(no_documents).count() == 0


def test_mixed_rows_without_ids_agree_on_reruns(spark):
    rows = [(None, f"text number w{i}", "ab"[i % 2]) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    once, again = (
        Counter(r["text"] for r in mixing.mixed(f).collect()) for f in (frame, frame.repartition(7))
    )
    assert once == again and max(once.values()) <= 2


# 7: SimHash


def simhash_of(text):
    words = text.encode().lower().split()
    size = min(3, len(words))
    runs = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if words else []
    counts = [0] * 64
    for run in runs:
        h = xxhash.xxh64_intdigest(run, seed=42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(runs))


def linked(prints):
    roots = {p: p for p in prints}

    def root(p):
        while roots[p] != p:
            p = roots[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= 3:
                roots[root(a)] = root(b)
    return {p: root(p) for p in prints}


@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
def test_simhash(request, name):
    frame = request.getfixturevalue(name)
    rows = [(key, simhash_of(text)) for key, text in pairs(frame)]
    groups = linked({p for _, p in rows})
    smallest = {}
    for key, p in rows:
        if key is not None:
            smallest[groups[p]] = min(key, smallest.get(groups[p], key))
    expected = [(key, f"{p:016x}", smallest.get(groups[p])) for key, p in rows]
    got = [tuple(r) for r in simhash.near_duplicates(frame).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("list_size", [8, 8192])
def test_links_of_crowded_lists(spark, list_size):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints)[:6]:
        for _ in range(30):  # chains of near copies
            for _ in range(rng.randrange(4)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    nodes = spark.createDataFrame(signed, "print long").withColumn("label", F.col("print"))
    edges = simhash.links(nodes.select("print"), list_size=list_size)
    roots = {r["print"] % 2**64: r["root"] for r in simhash.components(nodes, edges).collect()}
    groups = defaultdict(set)
    for p, group in linked(prints).items():
        groups[group].add(p)
    for members in groups.values():
        found = {roots.get(p) for p in members}
        least = min(p - 2**64 if p >= 2**63 else p for p in members)
        assert found == ({least} if len(members) > 1 else {None})


def test_one_per_group(odd_documents):
    kept = simhash.one_per_group(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 2, 6, 7, 8, None]


def test_one_per_group_where_ids_are_equal_or_missing(spark):
    a, b, c, d = (" ".join(f"{letter}{i}" for i in range(40)) for letter in "abcd")
    rows = [(None, a), (None, a), (None, b), (4, b), (4, c), (4, c), (5, c), (None, None), (None, d)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = [tuple(r) for r in simhash.one_per_group(frame).collect()]
    expected = [(None, a), (4, b), (4, c), (None, None), (None, d)]
    assert sorted(kept, key=str) == sorted(expected, key=str)
    found = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(frame).collect()}
    assert found == {(None, None), (None, 4), (4, 4), (5, 4)}
    assert simhash.one_per_group(frame.where("false")).count() == 0


# 8: lines


def test_line_dedup(spark):
    passage = " ".join(f"Word{i}" for i in range(55))
    rows = [
        (3, f"start\n{passage}\nend", "q"),
        (1, f"{passage.upper()} \nshort line", "q"),
        (2, f"short line\n{passage}\n\n{passage}", None),
        (4, None, None),
        (None, passage, None),
        (5, "", None),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, place string")
    got = {r["doc_id"]: r for r in line_dedup.without_repeats(frame).collect()}
    assert got[1]["text"] == rows[1][1] and got[4]["text"] is None and got[5]["text"] == ""
    assert got[3]["text"] == "start\nend" and got[2]["text"] == "short line\n" and got[None]["text"] == ""
    span = got[3]["removed_spans"][0]
    assert rows[0][1][span["begin"] : span["end"]] == passage and span["first_id"] == 1
    assert [s["begin"] for s in got[2]["removed_spans"]] == [11, 11 + len(passage) + 2]
    assert line_dedup.without_repeats(frame.where("false")).count() == 0


def test_passages_inside_lines(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9)))
    own = lambda n: " ".join(word() for _ in range(n))
    passages = [own(rng.randrange(55, 90)) for _ in range(40)]
    rows, whole = [], {}
    for i in range(200):
        text = own(30)
        if i % 2:
            passage = passages[i // 2 % 40]
            whole[i] = passage.split()
            # Begins and ends inside lines; the first half of it may stand on a line of its own.
            text += " " + passage + rng.choice([" ", "  "]) + own(20) + "\n" + own(9)
        rows.append((i, text + "\n" + own(15)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in line_dedup.without_repeats(frame).collect()}
    missed = 0
    for i, text in rows:
        spans = got[i]["removed_spans"]
        if i % 2 == 0 or i < 80:
            assert got[i]["text"] == text and spans == []
            continue
        if not spans:  # too few cuts in it that do not depend on the text around it
            missed += 1
            continue
        assert len(spans) == 1 and spans[0]["first_id"] % 80 == i % 80
        cut = text[spans[0]["begin"] : spans[0]["end"]].split()
        assert len(cut) == spans[0]["words"] >= line_dedup.RUN_WORDS
        # Only words of the passage go, and all but a unit's words at either end.
        assert " ".join(cut) in " ".join(whole[i])
        assert len(cut) >= len(whole[i]) - 2 * 16
        assert got[i]["text"].split() == [
            *text[: spans[0]["begin"]].split(), *text[spans[0]["end"] :].split()
        ]
    assert missed <= 3


def test_what_a_text_repeats_of_itself_stays(spark):
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{line}\n{line}"), (2, "a " * 300), (3, "a " * 300 + "end")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(frame).collect()}
    assert got[1] == rows[0][1] and got[2] == rows[1][1] and len(got[3].split()) < 40


def test_what_a_text_repeats_of_itself_goes_in_the_pipeline(spark):
    line, other = (" ".join(f"{letter}{i}" for i in range(60)) for letter in "wv")
    rows = [
        (1, f"{line}\nbetween\n{line}\nend"),
        (2, f"{other}\n{line}\n{other}"),
        (3, "a " * 300 + "end"),
        (None, f"{line}\n{other}\n{line}"),
        (4, None),
    ]
    frame = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string").repartition(3)
    left = corpus_pipeline.line_dedup_stage(spark, frame, "")
    found = Counter((r["doc_id"], r["text"]) for r in left.collect())
    assert found.pop((1, f"{line}\nbetween\nend")) == 2
    texts = {key: text for key, text in found}
    assert 0 < len(texts.pop(3).split()) <= 32  # the first pair of units
    assert texts == {2: other, None: "", 4: None}
    spans = {
        r["doc_id"]: r["removed_spans"]
        for r in line_dedup.without_repeats(frame, within=True).collect()
    }
    begin = len(line) + len("\nbetween\n")
    assert [tuple(s) for s in spans[1]] == [(begin, begin + len(line), 60, 1)]


def test_line_dedup_where_ids_are_equal_or_missing(spark):
    a, b, c, d = (" ".join(f"{letter}{i}" for i in range(55)) for letter in "abcd")
    rows = [(1, a), (1, f"{b}\n{a}"), (None, f"{a}\n{c}"), (None, f"{d}\n{c}"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = Counter(u for r in line_dedup.without_repeats(frame).collect() for u in (r["text"] or "").split("\n"))
    assert {u: n for u, n in left.items() if u} == {a: 1, b: 1, c: 1, d: 1}


def test_pipeline_removes_passages_of_short_lines(spark):
    verse = [" ".join(f"v{i}w{j}" for j in range(6)) for i in range(12)]
    rows = [
        (1, "\n".join(verse)),
        (2, "\n".join(["own line", *verse[:5], "", *verse[5:9], "end"])),  # 54 words in a row
        (3, "\n".join([*verse[:4], "between", *verse[4:8]])),  # 24 words, twice
        (4, "\n".join(verse[:9])),
        (5, None),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = corpus_pipeline.line_dedup_stage(spark, frame, "")
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {
        1: rows[0][1], 2: "own line\n\nend", 3: rows[2][1], 4: "", 5: None,
    }


# 9: languages


def test_languages_on_rows_kept_for_testing(spark):
    folder = FOLDER.replace("0.001", "0.01")
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = [r for r in queries.op9_language(spark, folder).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows]) > 0.98


def test_spans_are_the_best_labelling():
    rng = np.random.default_rng(6)
    scores, counts = -rng.exponential(3, (900, 3)), np.array([0, 300, 1, 0, 599])
    scores[100:140, 1:] -= 20
    got = language.labelled(scores, counts, 5.0)
    assert got.tolist() == [
        *language.viterbi(scores[:300], 5.0),
        *language.viterbi(scores[300:301], 5.0),
        *language.viterbi(scores[301:], 5.0),
    ]


def test_short_mixed_texts_get_the_best_labelling():
    rng = np.random.default_rng(11)
    counts = rng.integers(1, 9, 4000)
    scores = -rng.exponential(8, (int(counts.sum()), 3))
    got = language.labelled(scores, counts, 12.0)

    def value(rows, labels):
        return rows[np.arange(len(rows)), labels].sum() - 12 * np.count_nonzero(np.diff(labels))

    end = np.cumsum(counts)
    for a, b in zip((end - counts).tolist(), end.tolist(), strict=True):
        best = value(scores[a:b], language.viterbi(scores[a:b], 12.0))
        assert value(scores[a:b], got[a:b]) == pytest.approx(best)
    mixed = np.array([[-10.0, 0, -30], [-10, -30, 0]])
    assert language.labelled(mixed, np.array([2]), 12.0).tolist() == [1, 2]


def test_language_odd_cases(spark, odd_documents, no_documents):
    model = language.learned_model(odd_documents)
    rows = language.languages(odd_documents, model).collect()
    assert len(rows) == odd_documents.count()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 5, 8)} == {"und"}
    nothing = language.learned_model(no_documents)
    assert {r["lang_pred"] for r in language.languages(odd_documents, nothing).collect()} == {"und"}
    mixed = spark.createDataFrame([(1, "das ist der hund " * 9 + "this is the dog " * 9)], "doc_id long, text string")
    train = spark.createDataFrame(
        [(i, t * 30, k) for i in range(20) for t, k in (("das ist der hund ", "de"), ("this is the dog ", "en"))],
        "doc_id long, text string, lang string",
    )
    row = language.languages(mixed, language.learned_model(train)).first()
    assert [s["lang"] for s in row["spans"]] == ["de", "en"]


# 10: licenses


def test_wrapped_notices_are_found(spark):
    notices = [(label, t) for t, label in licenses.TEMPLATES]
    rows = [
        (100 * width + i, "own code\n# " + "\n# ".join(textwrap.wrap(t, width)) + "\nmore")
        for width in (24, 72, 80)
        for i, (_, t) in enumerate(notices)
    ]
    # Words that are far apart make no block; the Kelvin sign is no k.
    scattered = (" other" * 70).join(["", *notices[6][1].split()])
    rows += [(9001, scattered), (9002, "all rights reserved wor\u212a"), (9003, "ALL\nRIGHTS\nreserved")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.license_report(frame).collect()}
    for width in (24, 72, 80):
        for i, (label, _) in enumerate(notices):
            assert label in got[100 * width + i]
    assert got[9001] == [""]
    assert got[9002] == got[9003] == ["reserved"]
    assert licenses.template_matches(frame.where("doc_id = 9001")).count() == 0


def license_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower) if w]


@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
def test_licenses(request, name, spark):
    frame = request.getfixturevalue(name)
    if name != "no_documents":
        extra = [(9090, "x CC-BY cc by\nGeneral  Public License"), (9091, "All Rights reserved."), (9092, "the MIT license: released under")]
        frame = frame.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    expected = []
    for key, text in pairs(frame):
        words = license_words(text)
        places, base, more = [], set(), set()
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            for i in range(len(words) - len(p) + 1):
                if words[i : i + len(p)] == p:
                    places.append(i)
                    base.add(label)
        best = 0.0
        for template, label in licenses.TEMPLATES:
            tokens = set(template.split())
            for i, word in enumerate(words):
                if word in tokens:
                    share = len(tokens & set(words[i : i + 2 * len(tokens)])) / len(tokens)
                    if share >= licenses.THRESHOLD:
                        more.add(label)
                        best = max(best, share)
        expected.append(
            (key, len(words), len(places), min(places, default=None), max(places, default=None),
             ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if base else best)
        )
    got = [tuple(r) for r in licenses.license_report(frame).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_licenses_where_ids_are_equal_or_missing(spark):
    texts = ["released under the MIT license", "nothing", "licensed under CC BY SA 4.0", ""]
    rows = [(key, text) for key in (None, 7) for text in texts]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["labels"]) for r in licenses.license_report(frame).collect())
    both = {"mit": 1, "": 2, "cc-by,cc-by-sa": 1}
    assert got == {(key, labels): n for key in (None, 7) for labels, n in both.items()}


# The pipeline


def test_pipeline_stages_on_empty_and_odd_tables(spark, documents, odd_documents):
    import corpus_pipeline

    names = documents.columns
    odd = odd_documents.select(
        "doc_id", "text", "lang", "source", F.col("score").cast("long").alias("n_chars")
    )
    for docs in (documents.where("false"), odd, odd.withColumn("key", F.lit("k"))):
        some = docs.count() > 0
        for _, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, FOLDER)
            rows = after.collect()
            if stage is not corpus_pipeline.STAGES[-1][1]:
                assert after.columns == docs.columns and names[0] in after.columns
                docs = spark.createDataFrame(rows, after.schema)
            assert some or rows == []


def test_pipeline_equals_its_stages_in_plain_python(spark):
    import corpus_pipeline

    folder = FOLDER
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        after = {r["doc_id"]: r for r in rows}
        assert after.keys() <= before.keys()
        if name == "near_dedup":
            groups = linked({simhash_of(r["text"]) for r in before.values()})
            firsts = {}
            for key in sorted(before):
                firsts.setdefault(groups[simhash_of(before[key]["text"])], key)
            assert sorted(r["doc_id"] for r in rows) == sorted(firsts.values())
        if name == "line_dedup":
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert corpus_pipeline.run(spark, folder).count() == docs.count()


# The chain's memory: few files, no Python processes besides those that do the work


def written_files(folder):
    return sum(1 for _ in Path(folder).rglob("part-*.parquet"))


@pytest.fixture
def many_partitions(spark, tmp_path, monkeypatch):
    """64 partitions that Spark does not put together; the shared folder is a new one."""
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    monkeypatch.setattr(shared, "shared_folder", lambda spark: str(tmp_path))
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield tmp_path
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def near_copies(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):
        text = " ".join(rng.choices(words, k=80))
        rows += [(2 * i, text, f"s{i % 3}", len(text)), (2 * i + 1, text + " end", f"s{i % 3}", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")


def test_few_rows_are_written_in_few_files(many_partitions, spark):
    frame = spark.range(1000).groupBy("id").count()
    assert stored(frame, files_for(1000)).count() == 1000
    assert written_files(many_partitions) == 1
    assert files_for(0) == 1 and files_for(1_000_000) == 11


def test_groups_and_mix_write_few_files_whatever_the_partitions(many_partitions, near_copies):
    groups = simhash.near_duplicates(near_copies).collect()
    prints = {r["doc_id"]: simhash_of(r["text"]) for r in near_copies.collect()}
    assert len(groups) == 240
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in groups} == prints
    by_prints = written_files(many_partitions)
    assert by_prints <= 30  # 204 with a file for each partition
    assert mixing.mix_report(near_copies).count() == 240
    assert written_files(many_partitions) - by_prints <= 60  # 115


def test_places_of_sources_need_no_python_process(spark, near_copies):
    sources = near_copies.groupBy("source").agg(F.sum("n_chars").alias("source_size"))
    ranked = mixing._ranked(sources)
    assert {r["source"]: r["place"] for r in ranked.collect()} == {"s0": 0, "s1": 1, "s2": 2}
    assert "ExistingRDD" not in ranked._jdf.queryExecution().toString()


def test_of_large_things_the_last_is_remembered(monkeypatch):
    monkeypatch.setattr(sys, "_tidegauge_remembered", {}, raising=False)
    monkeypatch.setattr(sys, "_tidegauge_large", None, raising=False)
    small, one = remembered("small", list), remembered("one", list, large=True)
    assert remembered("one", list, large=True) is one
    other = remembered("other", list, large=True)
    assert remembered("small", list) is small
    assert list(sys._tidegauge_remembered) == ["small", "other"]
    assert remembered("other", list, large=True) is other


def test_results_have_tasks_of_many_texts(many_partitions, near_copies):
    for result in (
        simhash.one_per_group(near_copies),
        mixing.mixed(near_copies),
        line_dedup.without_repeats(near_copies, within=True),
    ):
        assert result.rdd.getNumPartitions() == 1  # 64 before
    assert in_fewer_tasks(near_copies.repartition(9), 4 * 2_500).rdd.getNumPartitions() == 5
    assert in_fewer_tasks(near_copies.repartition(9), 10**6).rdd.getNumPartitions() == 9
