"""Message topics, read through Spark's Kafka source.

The connector is a separate Spark artefact; the session must be started with
it.  Progress is kept in the query's checkpoint; a group id only names the
consumer to the broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Topic and group names of the deployed system.
MEASUREMENTS_TOPIC = "channel.measurements"
MEASUREMENTS_GROUP = "group.channel.measurements"
REPORTS_TOPIC = "sink.measurement_reports"
CLEANED_TOPIC = "sink.cleaned_measurements"
TRANSACTIONS_TOPIC = "input_topic"
TRANSACTIONS_GROUP = "fraud_detection_group"
ALERTS_TOPIC = "output_topic"
DEFAULT_SERVERS = "localhost:9092"


def source_options(
    topic: str,
    servers: str = DEFAULT_SERVERS,
    start: str = "earliest",
    group: str | None = None,
    records_per_batch: int = 10_000_000,
) -> dict[str, str]:
    """Options of the topic source; ``start`` is where a query without progress begins."""
    if start not in ("earliest", "latest"):
        raise ValueError(f"start must be 'earliest' or 'latest', not {start!r}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "maxOffsetsPerTrigger": str(records_per_batch),
    }
    if group:
        options["kafka.group.id"] = group
    return options


def topic_stream(spark: SparkSession, **options) -> DataFrame:
    """A topic as a stream of (value text, timestamp of the transport)."""
    raw = spark.readStream.format("kafka").options(**source_options(**options)).load()
    return raw.select(F.col("value").cast("string").alias("value"), "timestamp")


def topic_table(spark: SparkSession, **options) -> DataFrame:
    """What a topic holds now, as a table of the same form."""
    chosen = source_options(**{**options, "start": "earliest"})
    chosen.pop("maxOffsetsPerTrigger")
    raw = spark.read.format("kafka").options(**chosen).load()
    return raw.select(F.col("value").cast("string").alias("value"), "timestamp")
