"""The named queries against their SQL, on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from tidegauge.catalog import ORACLES, QUERIES
from tidegauge.session import LIBRARY_SETTINGS
from oracle import connected, oracle_rows, spark_rows

FOLDER = os.environ.get("TIDEGAUGE_TEST_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connected(FOLDER)


def test_flagship_has_rows(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLES.keys() <= entry_point.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    columns, rows = spark_rows(entry_point.queries()[name](spark, FOLDER))
    assert rows
    assert (columns, rows) == oracle_rows(connection, entry_point.oracle_sql()[name])


@pytest.mark.parametrize("leftover", [False, True])
def test_entry_point_without_the_training_data_operators(tmp_path, leftover):
    here = Path(entry_point.__file__).parent
    shutil.copy(here / "__spark_entry__.py", tmp_path)
    skip = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(here / "tidegauge", tmp_path / "tidegauge", ignore=skip)
    if leftover:
        (tmp_path / "tidegauge" / "llm" / "__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert run.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], run.stderr


def test_queries_leave_the_settings_of_the_session(spark):
    before = {key: spark.conf.get(key) for key in LIBRARY_SETTINGS}
    try:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        QUERIES["tumble_count"](spark, FOLDER)
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
