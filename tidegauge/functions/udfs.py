"""Functions callable from SQL text.

Built-in expressions come first: they stay in generated code and let filters
reach the scan.  A registered function is kept for users who call their own
Python from SQL; it works on whole Arrow batches.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register_doubling(spark: SparkSession, name: str = "my_udf") -> None:
    """Register a vectorised integer function x -> 2 x under ``name``.

    Nullable integers keep NULL as NULL; a plain integer series would turn a
    batch with a NULL into floats.
    """

    @F.pandas_udf("int")
    def doubled(values: pd.Series) -> pd.Series:
        return values.astype("Int64") * 2

    spark.udf.register(name, doubled)


def select_with(frame: DataFrame, view: str, query: str) -> DataFrame:
    """Run SQL text over ``frame``, visible to this text alone as ``view``.

    A temporary view of that name that is there already is an error.
    """
    spark = frame.sparkSession
    frame.createTempView(view)
    try:
        return spark.sql(query)
    finally:
        spark.catalog.dropTempView(view)
