"""A training-data pipeline: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm import bpe, line_dedup, mixing, quality, simhash
from tidegauge.llm.queries import RANKS
from tidegauge.plans.shared import stored
from tidegauge.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.trained_model(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.one_per_group(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand earlier, in others or themselves; counted anew."""
    left = line_dedup.without_repeats(docs, spans=None, within=True)
    return line_dedup.recounted(left)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, ids and the round trip of every document taken, as digests."""
    return bpe.encoding_digests(docs, RANKS)


STAGES: list[tuple[str, Stage]] = [
    ("quality", classify),
    ("near_dedup", near_dedup),
    ("line_dedup", line_dedup_stage),
    ("mix", mix),
    ("encode", encode),
]

#: A trained network and the mix have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
