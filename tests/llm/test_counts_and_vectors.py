"""Token counts, hard negatives and centroid clusters against plain Python."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from conftest import FOLDER
from tidegauge.llm import centroids, hard_negatives, queries, token_counts

# 11: token counts


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def pieces():
    with open(queries.PIECES, "rb") as file:
        return token_counts.Pieces(file.read())


ODD_TEXTS = [
    "", " ", "   ", "\n", "a", " a", "  a  b ", "a\nb", "\n\n a", "▁a ▁", "<s>a</s><unk>", "<0x0A>",
    "日本語 text", "a\0b", "ﬁ½ Ⅷ", "\t\ta", "a　b", "é", "\U0001f600" * 20, "=" * 400, " " * 70 + "x",
    "-" * 33 + " " * 17, "word" * 3000, "aaa " * 500, "x" + " " * 40 + "\n" * 9 + "y",
]


def test_counts_of_all_prefixes(library, pieces):
    rng = random.Random(2)
    parts = [" ", "  ", "\n", "the", "ing", "é", "日", "=", "==", "a", "e", "t", "1", "▁", "\U0001f600", " th"]
    texts = ODD_TEXTS + ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(600)]
    texts += ["".join(rng.choices("aeinorst ", k=rng.randrange(80))) for _ in range(400)]
    for text in texts:
        if len(text) > 500:
            assert pieces.total(text) == len(library.encode(text))
            continue
        expected = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        assert pieces.prefixes(text).tolist() == expected, text


def test_counts_of_documents(spark, documents, odd_documents, no_documents, library):
    frame = documents.select("doc_id", "text").union(odd_documents.select("doc_id", "text"))
    rows = token_counts.counted(frame, queries.PIECES, budget=50).collect()
    assert len(rows) == frame.count()
    for r in rows:
        text = r["text"] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), len(library.encode(text)))
        if r["fitting_chars"] < len(text):
            assert len(library.encode(text[: r["fitting_chars"]])) <= 50
            assert len(library.encode(text[: r["fitting_chars"] + 1])) > 50
    assert token_counts.counted(no_documents, queries.PIECES).count() == 0


def test_stored_prefixes_answer_budgets(spark, library, tmp_path):
    rng = random.Random(4)
    texts = ["".join(rng.choices("aeint é日\n=", k=n)) for n in (0, 1, 1023, 1024, 1025, 5000)]
    rows = [(i, t, "kept", 7 * i) for i, t in enumerate([*texts, None])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, N_Tokens string, wanted int")
    token_counts.counted(frame, queries.PIECES).write.parquet(str(tmp_path / "counts"))
    stored = spark.read.parquet(str(tmp_path / "counts"))
    assert stored.columns[:3] == ["doc_id", "text", "wanted"]  # the count replaces N_Tokens
    places = [0, 1, 5, 1000, 1024, 1030, 4999, 10**6, None]
    asked = stored.withColumn("at", F.explode(F.array(*[F.lit(p).cast("long") for p in places])))
    for r in token_counts.tokens_before(asked, "at").collect():
        text = r["text"] or ""
        expected = None if r["at"] is None else len(library.encode(text[: r["at"]]))
        assert r["tokens_before"] == expected
    for r in token_counts.cut_to_budget(stored, 300).collect():
        if r["text"] is not None:
            assert r["kept_tokens"] == len(library.encode(r["text"])) <= 300
            assert r["text"] == texts[r["doc_id"]] or len(r["text"]) < len(texts[r["doc_id"]])


def test_counts_of_wide_changes():
    counts = np.array([0, 1, 200, 3, 4])
    width, changes, marks = token_counts.stored_form(counts)
    assert width == 4 and token_counts.all_counts(width, changes).tolist() == counts.tolist()
    assert [token_counts.prefix_count(width, changes, marks, i) for i in range(5)] == counts.tolist()


# 12: hard negatives


def plain_negatives(rows, is_anchor, positives=5, negatives=5):
    """Rows (id, label, weights): the result, every pair looked at."""
    found = []
    for anchor, label, vector in rows:
        if not is_anchor(anchor):
            continue
        scored = [
            (-int(np.dot(vector, w)), i, one) for i, one, w in rows if i != anchor and len(w) == len(vector)
        ]
        near = sorted((s, i) for s, i, one in scored if one == label)[:positives]
        for s, positive in near:
            p = -s
            hard = [(s, i) for s, i, one in scored if one != label and 80 * p <= -100 * s <= 100 * p]
            for rank, (s, i) in enumerate(sorted(hard)[:negatives], 1):
                found.append((anchor, positive, rank, i, p, -s))
    return sorted(found)


@pytest.mark.parametrize("n_dims", [1, 2, 3, 24])
def test_hard_negatives(spark, monkeypatch, n_dims):
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", 300)
    monkeypatch.setattr(hard_negatives, "QUERY_ROWS", 20)
    monkeypatch.setattr(hard_negatives, "GROUP_BLOCKS", 2)
    rng = np.random.default_rng(n_dims)
    vectors = np.round(rng.normal(0.1, 0.5, (900, n_dims)), 1)  # many ties
    labels = rng.choice(4, 900, p=[0.7, 0.1, 0.1, 0.1])
    rows = [(i, int(a), v.tolist(), "x") for i, (a, v) in enumerate(zip(labels, vectors, strict=True))]
    odd = [(1000, None, rows[0][2], "y"), (1001, 1, None, "y"), (1002, 1, [None] * n_dims, "y"),
           (1003, 1, [float("nan")] * n_dims, None), (1004, 1, [float("inf")] * n_dims, None),
           (None, 1, rows[0][2], None), (1005, 1, [0.5] * (n_dims + 1), None), (1006, 1, [], None)]
    schema = "vec_id long, label int, embedding array<double>, score string"
    frame = spark.createDataFrame(rows + odd, schema).repartition(4)
    got = hard_negatives.hard_negatives(frame, F.col("vec_id") % 15 == 0, F.col("label"))
    whole = [(i, a, np.floor(256 * np.array(v)).astype(int)) for i, a, v, _ in rows]
    assert sorted(map(tuple, got.collect())) == plain_negatives(whole, lambda i: i % 15 == 0)


def test_hard_negatives_of_repeated_rows_and_none(spark):
    schema = "vec_id long, label int, embedding array<float>"
    rows = [(1, 0, [1.0, 0.0]), (1, 0, [1.0, 0.0]), (2, 0, [1.0, 0.0]), (3, 1, [0.9, 0.0]), (3, 1, [0.9, 0.0])]
    frame = spark.createDataFrame(rows, schema)
    got = hard_negatives.hard_negatives(frame, F.col("vec_id") == 1, F.col("label")).collect()
    assert sorted(map(tuple, got)) == [(1, 2, 1, 3, 65536, 256 * 230)]
    nothing = hard_negatives.hard_negatives(frame.where("false"), F.lit(True), F.col("label"))
    assert nothing.columns[0] == "anchor_id" and nothing.count() == 0


def test_boxes_bound_the_scores_in_them():
    rng = np.random.default_rng(5)
    weights = rng.integers(-50, 50, (3000, 6))
    tree = hard_negatives.Tree(np.arange(3000), rng.integers(0, 3, 3000), weights)
    query = rng.integers(-50, 50, 6)
    assert len(tree.levels) == 2 and sorted(tree.keys.tolist()) == list(range(3000))
    low, high, least, greatest = tree._bounds(0, slice(0, len(tree.levels[0][0])), query)
    for i, (a, b) in enumerate(zip(tree.starts, tree.starts[1:], strict=False)):
        scores = tree.weights[a:b] @ query
        assert low[i] <= scores.min() and scores.max() <= high[i]
        assert least[i] == greatest[i] == tree.labels[a]


# 13: centroids


def plain_clusters(rows, k, rounds, dims, scale):
    """Rows (id, vector): (id, cluster, distance) of all, and the centroids, in whole numbers."""
    kept = [
        (i, np.floor(scale * np.array(v, float)).astype(int).tolist())
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(middle))

    for _ in range(rounds):
        homes = [nearest(v)[1] for _, v in kept]
        for n in range(len(middle)):
            own = [v for (_, v), home in zip(kept, homes, strict=True) if home == n]
            if own:
                middle[n] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    return sorted((i, n, d) for i, v in kept for d, n in [nearest(v)]), middle


@pytest.mark.parametrize(("n", "k"), [(400, 7), (3, 16), (60, 1)])
def test_clusters(spark, n, k):
    rng = np.random.default_rng(n)
    rows = [(i, np.round(rng.normal(0, 0.4, 8), 1).tolist()) for i in range(n)]
    rows += [(i + 1000, rows[0][1]) for i in range(40)]  # equal vectors
    rows += [(0, rows[0][1]), (2000, None), (2001, [None] * 8), (2002, [float("inf")] * 8), (2003, [0.1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    expected, middle = plain_clusters(rows, k, 3, 8, 64)
    got = centroids.cluster_report(frame, k, dims=8).collect()
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in got) == expected
    for r in got:
        assert r["inertia"] == sum(d for *_, d in expected)
        assert r["cluster_inertia"] == sum(d for _, c, d in expected if c == r["cluster"])
        text = ",".join(map(str, middle[r["cluster"]]))
        assert r["centroid_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_clusters_of_nothing_and_of_huge_components(spark):
    schema = "vec_id long, embedding array<double>"
    assert centroids.cluster_report(spark.createDataFrame([], schema), dims=2).collect() == []
    one = centroids.cluster_report(spark.createDataFrame([(None, [1.0, 2.0])], schema), dims=2)
    assert [(r["vec_id"], r["distance"]) for r in one.collect()] == [(None, 0)]
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [1.0, 1.0])], schema)
    with pytest.raises(Exception, match="a component is beyond"):
        centroids.cluster_report(huge, dims=2).collect()


def test_nearest_equals_all_distances():
    rng = np.random.default_rng(8)
    for spread in (1, 30, 2**23):
        middle = rng.integers(-spread, spread + 1, (50, 16))
        rows = rng.integers(-spread, spread + 1, (2000, 16))
        number, distance = centroids.Nearest(middle).find(rows)
        every = ((rows[:, None, :] - middle[None, :, :]) ** 2).sum(axis=2)
        assert number.tolist() == every.argmin(axis=1).tolist()
        assert distance.tolist() == every.min(axis=1).tolist()


@pytest.mark.parametrize("name", ["op11_token_counts", "op12_hard_negatives", "op13_centroids"])
def test_queries_read_whole_tables(spark, name):
    rows = queries.QUERIES[name](spark, FOLDER).count()
    table = "documents" if name == "op11_token_counts" else "embeddings"
    n = spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
    assert rows == n or name == "op12_hard_negatives" and rows > 0
