"""Named queries over the test tables, each with the SQL it must agree with."""

from tidegauge.catalog import batch, split, streams
from tidegauge.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "batch", "split", "streams"]
