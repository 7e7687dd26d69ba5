"""License scans: phrases in a text, and an exact set-similarity join on its blocks.

A template is a set of ``t`` words. A block is any run of ``2 t`` words of a text, across
line ends; it matches a template if it holds at least a given share of the template's
words. Words are ordered by the number of texts they occur in, over the whole table,
rarest first. With ``o = ceil(share * t)`` words needed, a text that has a matching block

- prefix: holds one of the template's ``t - o + 1`` rarest words;
- length: holds at least ``o`` words of the templates at all;
- position: from its and the template's first common word on, has ``o`` words left.

Of the texts that pass, the blocks are verified: every block that begins with a word of
the template, which some best block does. Only words of templates take part; templates
are a small fixed table and the only thing that is sent to all tasks. Everything is made
of DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import text_mark

THRESHOLD = 0.9
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases and their labels (fixed values).
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
#: Templates and their labels (fixed values: usual notices of public licenses).
TEMPLATES = (
    ("all rights reserved", "reserved"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    (
        "this program is free software you can redistribute it and or modify it under the "
        "terms of the gnu general public license as published by the free software foundation",
        "gpl",
    ),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
        "mit",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        "bsd",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mpl-2.0",
    ),
)


def words(text: Column) -> Column:
    """Words of a text in order: runs of letters, digits and anything beyond ASCII."""
    text = F.coalesce(text, F.lit(""))
    # Only A-Z have lower forms here; in ASCII texts these are all, which is quicker.
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, ascii_uppercase, ascii_lowercase)
    )
    found = F.split(lowered, SEPARATORS, -1)
    return F.array_remove(found, "")


def _starts(tokens: str, phrase: str) -> Column:
    """Places in the array ``tokens`` where the words of a phrase stand in a row."""
    parts = phrase.split()
    own = F.col(tokens)
    held = F.lit(True)
    for part in parts:
        held = held & F.array_contains(own, part)

    def here(i: Column) -> Column:
        good = F.lit(True)
        for k, part in enumerate(parts):
            good = good & (F.get(own, i + k) == part)
        return good

    places = F.filter(F.sequence(F.lit(0), F.size(own) - len(parts)), here)
    enough = held & (F.size(own) >= len(parts))
    return F.when(enough, places).otherwise(F.array().cast("array<int>"))


def _each(value: Column, function: Callable[[Column], Column]) -> Column:
    """``function`` of a value that is worked out once, however often it is used.

    As a generated column its own filters stay above it and do not repeat its work.
    """
    return F.explode(F.transform(F.array(value), function))


def _sets(documents: DataFrame, vocabulary: Column) -> DataFrame:
    """Texts as their words, and as the words of the vocabulary they hold, in its order."""

    def both(own: Column) -> Column:
        return F.struct(own.alias("words"), F.array_intersect(vocabulary, own).alias("held"))

    found = documents.select("doc_id", "mark", _each(words(F.col("text")), both).alias("of"))
    return found.select("doc_id", "mark", "of.words", "of.held")


def _most_in_a_block() -> Column:
    """The most words of the template ``tokens`` in a block of twice its ``size`` in ``words``."""
    placed = F.transform("words", lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    own = F.filter(placed, lambda p: F.array_contains(F.col("tokens"), p["w"]))
    length = F.col("size") * 2

    def most(own: Column) -> Column:
        def held(first: Column, nth: Column) -> Column:
            # A block holds no more places of these words than it has words.
            near = F.slice(own, nth + 1, length)
            inside = F.filter(near, lambda p: p["i"] < first["i"] + length)
            return F.size(F.array_distinct(F.transform(inside, lambda p: p["w"])))

        return F.array_max(F.transform(own, held))

    return _each(own, most)


def _marked(documents: DataFrame, key: str, text: str) -> DataFrame:
    own = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return own.withColumn("mark", text_mark(F.col("text")))


def _literal(tokens: list[str]) -> Column:
    return F.array(*[F.lit(t) for t in tokens])


def template_matches(
    documents: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``mark``, ``label`` and ``containment`` of every text and template that
    match: the containment is that of the text's best block.

    A text may match several templates. ``mark`` is a hash of the whole text, by which
    rows of ``documents`` with an equal id are told apart. A null or empty text has no
    matches.
    """
    spark = documents.sparkSession
    own = _marked(documents, key, text)
    sets = [sorted(set(t.split())) for t, _ in templates]
    vocabulary = sorted(set().union(*sets))
    seen = (
        _sets(own, _literal(vocabulary))
        .select(F.explode("held").alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # at most the words of the templates
    )
    frequency = {row["token"]: row["n"] for row in seen}
    vocabulary.sort(key=lambda token: (frequency.get(token, 0), token))
    place = {token: i for i, token in enumerate(vocabulary)}

    rows, needs = [], []
    for number, ((_, label), tokens) in enumerate(zip(templates, sets, strict=True)):
        tokens = sorted(tokens, key=place.__getitem__)
        need = max(1, math.ceil(threshold * len(tokens) - 1e-9))
        needs.append(need)
        for i, token in enumerate(tokens[: len(tokens) - need + 1]):
            rows.append((token, number, i, len(tokens), need, label, tokens))
    index = spark.createDataFrame(
        rows,
        "token string, template int, i int, size int, need int, label string, tokens array<string>",
    )
    prefixes = sorted({r[0] for r in rows}, key=place.__getitem__)
    texts = _sets(own, _literal(vocabulary)).where(
        (F.size("held") >= min(needs)) & F.arrays_overlap("held", _literal(prefixes))
    )
    candidates = (
        texts.select("doc_id", "mark", "words", "held", F.posexplode("held").alias("j", "token"))
        .join(F.broadcast(index), "token")
        .where(
            (F.size("held") >= F.col("need"))
            & (F.least(F.col("size") - F.col("i"), F.size("held") - F.col("j")) >= F.col("need"))
        )
    )
    common = F.array_intersect("tokens", "held")
    # The first common word is enough: a pair is looked at once.
    pairs = candidates.withColumn("common", common).where(
        (F.size("common") >= F.col("need")) & (F.get("common", F.lit(0)) == F.col("token"))
    )
    return (
        pairs.select("doc_id", "mark", "label", "size", "need", _most_in_a_block().alias("most"))
        .where(F.col("most") >= F.col("need"))
        .select("doc_id", "mark", "label", (F.col("most") / F.col("size")).alias("containment"))
    )


def license_report(
    documents: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Licenses of every document.

    Returns doc_id, n_words, n_base (places of the phrases), first_word and
    last_word (their smallest and largest start, in words from 0, or null),
    base_labels, labels (those and the templates'; both distinct, sorted and joined
    by commas, empty if none) and score: 1 with a phrase, else the largest share of
    a template that a matching block holds, 0 without any. A null text is empty. Every row
    stands for itself, also where ids are equal or missing. Empty tables give no
    rows; other columns are ignored.
    """
    own = _marked(documents, key, text)
    read = own.select("doc_id", "mark", words(F.col("text")).alias("tokens"))
    for i, (phrase, _) in enumerate(PHRASES):
        read = read.withColumn(f"at{i}", _starts("tokens", phrase))
    at = [f"at{i}" for i in range(len(PHRASES))]
    all_places = F.concat(*at)
    none = F.array().cast("array<string>")
    base = F.concat(
        *[
            F.when(F.size(a) > 0, F.array(F.lit(label))).otherwise(none)
            for a, (_, label) in zip(at, PHRASES, strict=True)
        ]
    )
    based = read.select(
        "doc_id",
        "mark",
        F.size("tokens").cast("long").alias("n_words"),
        F.size(all_places).cast("long").alias("n_base"),
        F.array_min(all_places).cast("long").alias("first_word"),
        F.array_max(all_places).cast("long").alias("last_word"),
        base.alias("base"),
    )
    found = (
        template_matches(own, templates, threshold, "doc_id", "text")
        .groupBy(F.col("doc_id").alias("found_id"), F.col("mark").alias("found_mark"))
        .agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    )
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", none))))
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("mark") == F.col("found_mark"))
    return based.join(found, same, "left").select(
        *["doc_id", "n_words", "n_base", "first_word", "last_word"],
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0))
        .otherwise(F.coalesce("best", F.lit(0.0)))
        .alias("score"),
    )
