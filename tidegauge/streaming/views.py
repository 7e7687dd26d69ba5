"""Streams as views, and queries on them as SQL text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidegauge.functions.expressions import as_schema

#: The window report on a view ``measurements`` with event times and a watermark.
REPORT_TEXT = """
    SELECT channel_id, window.start AS window_start, window.end AS window_end,
        CAST(1 AS DOUBLE) AS hourly_frequency,
        count(channel_value) AS total,
        CASE WHEN count(channel_value) > 0 THEN array_join(transform(array_sort(
            collect_list(CASE WHEN channel_value IS NOT NULL
                THEN named_struct('t', event_time, 'v', channel_value) END)),
            r -> CAST(r.v AS STRING)), ',') END AS readings,
        round(round(avg(channel_value), 6), 1) AS average,
        round(max(channel_value), 1) AS highest,
        round(min(channel_value), 1) AS lowest,
        round(round(stddev_samp(channel_value), 6), 1) AS deviation
    FROM measurements
    GROUP BY channel_id, window(event_time, '5 minutes')
"""


def sql_stream(
    spark: SparkSession, text: str, views: Mapping[str, DataFrame], sink: T.StructType
) -> DataFrame:
    """The query ``text`` on streams under the names of ``views``, planned for a sink.

    The planned columns go to the sink's by position and take their names.  A query with
    another number of columns, or with one that cannot become the sink's type, is refused
    here, before anything runs.  The names are there while the text is planned only; a view
    of the session by the same name stays hidden for that time and is restored.
    """
    restored = {}
    for name, frame in views.items():
        if any(t.name == name.lower() and t.isTemporary for t in spark.catalog.listTables()):
            restored[name] = spark.table(name)
        frame.createOrReplaceTempView(name)
    try:
        return as_schema(spark.sql(text), sink)
    finally:
        for name in views:
            if name in restored:
                restored[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)
