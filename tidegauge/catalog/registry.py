"""The table of named queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidegauge.session import LIBRARY_SETTINGS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


@contextmanager
def library_settings(spark: SparkSession) -> Iterator[None]:
    """The library's settings while a query is planned; the caller's are restored.

    What a plan needs of them, such as the time zone of its casts, is in the plan then.
    """
    before = {key: spark.conf.get(key, None) for key in LIBRARY_SETTINGS}
    try:
        for key, value in LIBRARY_SETTINGS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function (spark, folder) -> DataFrame under its own name."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            with library_settings(spark):
                return function(spark, folder)

        QUERIES[function.__name__] = run
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return run

    return register
