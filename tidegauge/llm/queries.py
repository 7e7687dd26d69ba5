"""The operators' queries over the test tables, and SQL where it can say the same.

Each takes (spark, folder) and reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import (
    bpe,
    centroids,
    fingerprints,
    hard_negatives,
    language,
    licenses,
    line_dedup,
    mixing,
    quality,
    simhash,
    token_counts,
    token_files,
    topk,
)
from tidegauge.llm.common import held_out
from tidegauge.sources.tables import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2
EVERY = 100
WRONG = 7
LABELS = 10


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents, written as Simple-8b blocks and described from the files."""
    return token_files.token_index(table(spark, folder, "documents"), TOKENIZER, END_ID)


def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best inner products of every hundredth vector with all others."""
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % EVERY == 0, k=10)


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded by ranks."""
    return bpe.encoding_digests(table(spark, folder, "documents"), RANKS)


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.edit_report(table(spark, folder, "documents"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents."""
    documents = table(spark, folder, "documents")
    model = quality.trained_model(documents, table(spark, folder, "labels"))
    return quality.scores(documents, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op6_mix(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix_report(table(spark, folder, "documents"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash components of all documents."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the passages of earlier ones, and where these stood."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    left = line_dedup.without_repeats(documents)
    span = F.transform("removed_spans", lambda s: F.concat_ws("-", s["begin"], s["end"]))
    first = F.transform("removed_spans", lambda s: s["first_id"].cast("string"))
    return left.select(
        "doc_id",
        F.size("removed_spans").cast("long").alias("n_removed"),
        F.array_join(span, ",").alias("removed"),
        F.array_join(first, ",").alias("first_ids"),
        "text",
    )


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of all documents."""
    documents = table(spark, folder, "documents")
    found = language.languages(documents, language.learned_model(documents))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licenses of all documents."""
    return licenses.license_report(table(spark, folder, "documents"))


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all documents, and how much of each fits the limit."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.counted(documents, PIECES, prefixes=False)
    over = F.col("n_tokens") > token_counts.LIMIT
    return counted.select("doc_id", "n_bytes", "n_tokens", over.alias("over_limit"), "fitting_chars")


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, where every seventh has a wrong label."""
    key, label = F.col("vec_id"), F.col("label")
    wrong = F.when(key % WRONG == 0, (label + 1) % LABELS).otherwise(label)
    return hard_negatives.hard_negatives(
        table(spark, folder, "embeddings"), key % EVERY == 0, wrong
    )


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors in 16 clusters after three rounds."""
    return centroids.cluster_report(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_files,
        op2_top_k,
        op3_bpe,
        op4_fingerprints,
        op5_quality,
        op6_mix,
        op7_simhash,
        op8_line_dedup,
        op9_language,
        op10_licenses,
        op11_token_counts,
        op12_hard_negatives,
        op13_centroids,
    )
}

_TOP_K_SQL = f"""
    WITH whole AS (
        SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v
        FROM embeddings
        WHERE embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0)
    SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score FROM scored
    WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
    QUALIFY rank <= 10
"""

_BLANK = "[\\x09-\\x0D\\x20]"

_LINES_SQL = f"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
            generate_subscripts(string_split(text, chr(10)), 1) AS line_no
        FROM documents),
    placed AS (
        SELECT *, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no)
            - length(line) - 1 AS line_at
        FROM lines),
    tokens AS (
        SELECT * EXCLUDE line, length(line) AS line_length,
            unnest(string_split_regex(line, '{_BLANK}')) AS token,
            generate_subscripts(string_split_regex(line, '{_BLANK}'), 1) AS token_no
        FROM placed),
    words AS (
        SELECT *, line_at + t_at AS b, line_at + t_at + length(token) AS e, lower(token) AS word,
            row_number() OVER (PARTITION BY doc_id ORDER BY line_no, token_no) AS no
        FROM (SELECT *, sum(length(token) + 1) OVER (PARTITION BY doc_id, line_no
            ORDER BY token_no) - length(token) - 1 AS t_at FROM tokens)
        WHERE token <> ''),
    marked AS (
        SELECT *, ('0x' || md5(word)[:4])::INT AS mark FROM words),
    counted AS (
        SELECT *, (3 * lag(mark) OVER line + mark) % {line_dedup.CUT_NUMBERS} AS number
        FROM marked WINDOW line AS (PARTITION BY doc_id, line_no ORDER BY no)),
    ending AS (
        SELECT *, coalesce(number < coalesce(min(number) OVER (line
                ROWS BETWEEN {line_dedup.CUT_REACH} PRECEDING AND 1 PRECEDING), 99999)
            AND number < coalesce(min(number) OVER (line
                ROWS BETWEEN 1 FOLLOWING AND {line_dedup.CUT_REACH} FOLLOWING), 99999), false)
            AS ends
        FROM counted WINDOW line AS (PARTITION BY doc_id, line_no ORDER BY no)),
    starting AS (
        SELECT *, coalesce(lag(ends) OVER line, true) AS starts
        FROM ending WINDOW line AS (PARTITION BY doc_id, line_no ORDER BY no)),
    parts AS (
        SELECT *, sum(starts::INT) OVER (PARTITION BY doc_id ORDER BY no) AS part FROM starting),
    numbered AS (
        SELECT *, (row_number() OVER (PARTITION BY doc_id, part ORDER BY no) - 1)
            // {line_dedup.UNIT_WORDS} AS nth
        FROM parts),
    units AS (
        SELECT doc_id, part, nth, string_agg(word, ' ' ORDER BY no) AS unit, count(*) AS n,
            min(no) AS first_no
        FROM numbered GROUP BY ALL),
    pairs AS (
        SELECT *, row_number() OVER here AS place, unit || ' ' || lead(unit) OVER here AS pair
        FROM units WINDOW here AS (PARTITION BY doc_id ORDER BY first_no)),
    ranked AS (
        SELECT *, min(doc_id) OVER (PARTITION BY pair) AS first_id FROM pairs
        WHERE pair IS NOT NULL),
    repeated AS (
        SELECT doc_id, place, first_id,
            place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run
        FROM ranked WHERE first_id < doc_id),
    runs AS (
        SELECT doc_id, run, min(place) AS first_place, max(place) AS last_place
        FROM repeated GROUP BY doc_id, run),
    lost AS (
        SELECT p.doc_id, part, nth, r.run, f.first_id
        FROM pairs p JOIN runs r
            ON p.doc_id = r.doc_id AND place BETWEEN first_place AND last_place + 1
        JOIN repeated f ON f.doc_id = r.doc_id AND f.place = least(p.place, last_place)
        QUALIFY sum(n) OVER (PARTITION BY p.doc_id, r.run) >= {line_dedup.RUN_WORDS}),
    owned AS (
        SELECT *, coalesce(lead(b) OVER (PARTITION BY doc_id, line_no ORDER BY no),
            line_at + line_length) AS stop
        FROM numbered LEFT JOIN lost USING (doc_id, part, nth)),
    spans AS (
        SELECT doc_id, line_no, run, min(b) AS b, max(e) AS e, arg_min(first_id, no) AS first_id
        FROM owned WHERE run IS NOT NULL GROUP BY ALL),
    listed AS (
        SELECT doc_id, count(*) AS n_removed,
            string_agg(b::BIGINT || '-' || e::BIGINT, ',' ORDER BY b) AS removed,
            string_agg(first_id::VARCHAR, ',' ORDER BY b) AS first_ids
        FROM spans GROUP BY doc_id),
    left_lines AS (
        SELECT o.doc_id, line_no, count(*) FILTER (run IS NULL) AS n_left,
            substr(any_value(text), any_value(line_at)::BIGINT + 1, (min(b) - any_value(line_at))::BIGINT)
            || coalesce(string_agg(substr(text, b::BIGINT + 1, (stop - b)::BIGINT), '' ORDER BY no)
                FILTER (run IS NULL), '') AS line
        FROM owned o JOIN documents USING (doc_id) GROUP BY ALL),
    joined AS (
        SELECT p.doc_id, string_agg(coalesce(l.line, p.line), chr(10) ORDER BY line_no) AS text
        FROM placed p LEFT JOIN left_lines l USING (doc_id, line_no)
        WHERE coalesce(n_left, 1) > 0 GROUP BY p.doc_id)
    SELECT d.doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed,
        coalesce(first_ids, '') AS first_ids,
        CASE WHEN d.text IS NOT NULL THEN coalesce(j.text, '') END AS text
    FROM documents d LEFT JOIN joined j USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


def _listed(pairs: tuple[tuple[str, str], ...]) -> str:
    return ", ".join(f"('{words}', '{label}')" for words, label in pairs)


_WORDS_SQL = (
    "[w FOR w IN string_split_regex({}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF w <> '']"
)

_LICENSES_SQL = f"""
    WITH read AS (
        SELECT doc_id, text, {_WORDS_SQL.format(f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')")} AS words
        FROM documents),
    phrases AS (
        SELECT string_split(words, ' ') AS phrase, label
        FROM (VALUES {_listed(licenses.PHRASES)}) t(words, label)),
    templates AS (
        SELECT list_distinct(string_split(words, ' ')) AS template, label
        FROM (VALUES {_listed(licenses.TEMPLATES)}) t(words, label)),
    tokens AS (
        SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place FROM read),
    runs AS (
        SELECT doc_id, place, [word, lead(word) OVER later, lead(word, 2) OVER later] AS run
        FROM tokens WINDOW later AS (PARTITION BY doc_id ORDER BY place)),
    placed AS (
        SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
            list(DISTINCT label) AS base
        FROM runs JOIN phrases ON run[:len(phrase)] = phrase GROUP BY doc_id),
    wanted AS (
        SELECT row_number() OVER () AS number, label, template, len(template) AS size
        FROM templates),
    places AS (
        SELECT doc_id, place, word, number, label, size
        FROM tokens JOIN (SELECT *, unnest(template) AS word FROM wanted) USING (word)),
    blocks AS (
        SELECT a.doc_id, a.number, a.label, a.size, count(DISTINCT b.word) AS common
        FROM places a JOIN places b ON a.doc_id = b.doc_id AND a.number = b.number
            AND b.place BETWEEN a.place AND a.place + 2 * a.size - 1
        GROUP BY a.doc_id, a.number, a.label, a.size, a.place),
    matched AS (
        SELECT doc_id, max(common / size) AS best, list(DISTINCT label) AS more
        FROM blocks WHERE common >= ceil({licenses.THRESHOLD} * size - 1e-9) GROUP BY doc_id)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base,
        first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
        coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
        coalesce(array_to_string(list_sort(list_distinct(
            list_concat(coalesce(base, []), coalesce(more, [])))), ','), '') AS labels,
        CASE WHEN base IS NOT NULL THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
    FROM read LEFT JOIN placed USING (doc_id) LEFT JOIN matched USING (doc_id)
"""

_NEGATIVES_SQL = f"""
    WITH kept AS (
        SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v,
            CASE WHEN vec_id % {WRONG} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
            list_inner_product(a.v, r.v)::BIGINT AS score
        FROM kept a JOIN kept r ON a.vec_id <> r.vec_id WHERE a.vec_id % {EVERY} = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, (row_number() OVER best)::INTEGER AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
    WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
    QUALIFY rank <= 5
"""


def _clusters_sql(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """Lloyd's rounds written out, one after another."""
    steps = [
        f"""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id,
                [floor({dims} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
            FROM embeddings
            WHERE len(embedding) = {dims}
                AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), vec_id, v) - 1 AS c, v AS m
            FROM kept QUALIFY c < {k})""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
                SELECT row, vec_id, v, c,
                    list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v, m)])::BIGINT AS d
                FROM kept, c{i}
                QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, c) = 1)"""
        )
        steps.append(
            f"""s{i} AS (
                SELECT c, place, sum(x) AS s, count(*) AS n
                FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i})
                GROUP BY c, place)"""
        )
        steps.append(
            f"""c{i + 1} AS MATERIALIZED (
                SELECT c, coalesce(moved, m) AS m FROM c{i} LEFT JOIN (
                    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY place) AS moved
                    FROM s{i} GROUP BY c) USING (c))"""
        )
    return f"""
        WITH {", ".join(steps)}
        SELECT vec_id, c::INTEGER AS cluster, d AS distance,
            (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
            (sum(d) OVER ())::BIGINT AS inertia,
            sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} USING (c)
    """


#: SQL with the same rows; trained models, BPE, token counts, fingerprints and the mix have none.
ORACLES: dict[str, str] = {
    "op2_top_k": _TOP_K_SQL,
    "op8_line_dedup": _LINES_SQL,
    "op10_licenses": _LICENSES_SQL,
    "op12_hard_negatives": _NEGATIVES_SQL,
    "op13_centroids": _clusters_sql(),
}
