"""Times the named queries and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores.
Every result is computed in full and written to a sink that discards it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidegauge.catalog import QUERIES  # noqa: E402
from tidegauge.session import local_session  # noqa: E402


def seconds(spark, name: str, folder: str) -> float:
    """Wall-clock time of one query, from the call to its last row."""
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    chosen = sys.argv[1:] or list(QUERIES)
    spark = local_session(cores, shuffle_partitions=int(cores))
    spark.sparkContext.setLogLevel("OFF")

    # Start the JVM's compiler and the Python workers outside the measurement.
    small = re.sub(r"sf[0-9.]+$", "sf0.001", folder)
    if Path(small).is_dir():
        for name in ("tumble_report_5m", "channel_throttle"):
            seconds(spark, name, small)

    times = {name: round(seconds(spark, name, folder), 3) for name in chosen}
    scale = re.search(r"sf([0-9.]+)$", folder)
    result = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
