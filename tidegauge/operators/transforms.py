"""Record-by-record transforms: arithmetic, splitting, JSON.

All are column expressions.  They add no shuffle, run in generated code on
tables and streams alike, and let column pruning and filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.schemas import CONTACT_JSON


def doubled(frame: DataFrame, column: str, out: str) -> DataFrame:
    """Add 2 x ``column``."""
    return frame.withColumn(out, F.col(column) * 2)


def nonzero(frame: DataFrame, column: str) -> DataFrame:
    """Drop rows where ``column`` is zero; a NULL is not zero and stays."""
    return frame.where(~F.col(column).eqNullSafe(0))


def words(frame: DataFrame, column: str, out: str) -> DataFrame:
    """Add the list of blank-separated words; adjacent blanks give empty words."""
    return frame.withColumn(out, F.split(column, " "))


def exploded_words(frame: DataFrame, column: str, out: str) -> DataFrame:
    """One row per word."""
    return frame.withColumn(out, F.explode(F.split(column, " ")))


def word_counts(frame: DataFrame, column: str, word: str, count: str, rows: str) -> DataFrame:
    """How often every word occurs, and in how many rows.

    A row is one document: rows that repeat a document count once each.  What a
    row adds is known within the row, so only vocabularies are shuffled.
    """
    words = F.split(column, " ")
    every = F.transform(
        words, lambda w: F.struct(w.alias("w"), F.lit(1).alias("n"), F.lit(0).alias("first"))
    )
    distinct = F.transform(
        F.array_distinct(words),
        lambda w: F.struct(w.alias("w"), F.lit(0).alias("n"), F.lit(1).alias("first")),
    )
    found = frame.select(F.explode(F.concat(every, distinct)).alias("found"))
    return found.groupBy(F.col("found.w").alias(word)).agg(
        F.sum("found.n").alias(count), F.sum("found.first").alias(rows)
    )


def json_incremented(
    frame: DataFrame, column: str, field: str = "tel", schema: T.StructType = CONTACT_JSON
) -> DataFrame:
    """Add one to ``field`` of a JSON document and write the document back."""
    document = F.from_json(column, schema)
    changed = document.withField(field, document[field] + 1)
    return frame.withColumn(column, F.to_json(changed))


def json_incremented_where(
    frame: DataFrame,
    condition,
    column: str,
    field: str = "tel",
    schema: T.StructType = CONTACT_JSON,
) -> DataFrame:
    """The same for rows that meet ``condition``, which is applied before the JSON is read."""
    return json_incremented(frame.where(condition), column, field, schema)


def json_fields(
    frame: DataFrame, column: str, paths: dict[str, str], schema: T.StructType = CONTACT_JSON
) -> DataFrame:
    """Add nested members (output name -> dotted path); the document is read once."""
    read = frame.withColumn("_document", F.from_json(column, schema))
    return read.select(
        *frame.columns, *[F.col(f"_document.{path}").alias(out) for out, path in paths.items()]
    )
