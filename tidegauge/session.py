"""A Spark session for local work: tests, the bench and examples.

On a cluster the session comes from the submitter; only the settings in
``LIBRARY_SETTINGS`` matter to this library there.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

LIBRARY_SETTINGS = {
    # Windows are aligned to the epoch in UTC and zone-less times are read in it.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(
    cores: int | str = 8, shuffle_partitions: int = 8, settings: dict[str, str] | None = None
) -> SparkSession:
    """A local session whose shared folder is a new folder under the temp dir."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidegauge")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    for key, value in {**LIBRARY_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
