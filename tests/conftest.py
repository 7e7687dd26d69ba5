import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidegauge.plans.skew import ROWS_PER_TASK  # noqa: E402
from tidegauge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tiny inputs: compiling costs more than it saves.
    quick = {"spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1"}
    session = local_session(cores=4, shuffle_partitions=3, settings=quick)
    yield session
    session.stop()


@pytest.fixture
def rows_per_task(spark):
    """Set the number of rows of one key that a task may take."""

    def limit(rows: int) -> None:
        spark.conf.set(ROWS_PER_TASK, str(rows))

    yield limit
    spark.conf.unset(ROWS_PER_TASK)


@pytest.fixture
def events(spark):
    return spark.read.parquet("/root/testdata/sf0.001/events.parquet")
