"""User functions (UDF1, UDF2): the slow path, Arrow-batched.

Built-in expressions are preferred everywhere; these exist for logic that
has no built-in form. Both transfer column batches through Arrow, never one
row at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _square(x: pd.Series) -> pd.Series:
    return x.astype("int64") * x.astype("int64")


def square(col):
    """UDF1: ``x * x`` as a vectorised Pandas UDF (created when first used)."""
    return F.pandas_udf(_square, "bigint")(col)


def register_square(spark: SparkSession, name: str = "square") -> None:
    """UDF1 for SQL: ``SELECT square(col) FROM ...``."""
    spark.udf.register(name, F.pandas_udf(_square, "bigint"))


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """UDF2: apply ``fn`` to every Arrow batch of rows (``mapInPandas``)."""

    def _run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(_run, schema)
