"""Keyed aggregates (AGG1-AGG9, AGG15-AGG18).

All are algebraic, so Spark plans a partial (map-side) aggregate before the
shuffle: a hot key costs one partial row per task, never one big task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindling.functions.rounding import round_half_up
from kindling.functions.scalar import int_div


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def count_by_value(df: DataFrame, column: str, key_type: str | None = None, count_col: str = "count") -> DataFrame:
    """AGG1 ``countByValue``; ``key_type="string"`` reproduces trap T10."""
    key = F.col(column)
    if key_type:
        key = key.cast(key_type)
    return df.groupBy(key.alias(column)).agg(F.count(F.lit(1)).alias(count_col))


def count_by_key(df: DataFrame, keys, count_col: str = "count") -> DataFrame:
    """AGG2 / AGG7: rows per key (``map((k,1)).reduceByKey(_+_)``)."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(count_col))


def sum_by_key(df: DataFrame, keys, value: str, out: str = "total", as_decimal: bool = False) -> DataFrame:
    """AGG3: sum per key; ``as_decimal`` sums money exactly as ``decimal(18,2)``."""
    v = F.col(value)
    if as_decimal:
        v = v.cast("decimal(18,2)")
    agg = F.sum(v)
    if as_decimal:
        agg = agg.cast("decimal(18,2)")
    return df.groupBy(*_cols(keys)).agg(agg.alias(out))


def min_by_key(df: DataFrame, keys, value, out: str = "min_value") -> DataFrame:
    """AGG4."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*_cols(keys)).agg(F.min(v).alias(out))


def max_by_key(df: DataFrame, keys, value, out: str = "max_value") -> DataFrame:
    """AGG5."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*_cols(keys)).agg(F.max(v).alias(out))


def avg_div_by_key(df: DataFrame, keys, value: str, out: str = "avg_value") -> DataFrame:
    """AGG6 / T3: integer average, ``sum div count`` truncated toward zero."""
    s = F.sum(F.col(value).cast("bigint"))
    n = F.count(F.col(value))
    return df.groupBy(*_cols(keys)).agg(int_div(s, n).alias(out))


def avg_by_key(df: DataFrame, keys, value: str, out: str = "avg_value", digits: int | None = None) -> DataFrame:
    """AGG17: exact mean (``groupBy().mean()``)."""
    a = F.avg(F.col(value))
    if digits is not None:
        a = F.round(a, digits)
    return df.groupBy(*_cols(keys)).agg(a.alias(out))


def reduce_all(df: DataFrame, *aggs: Column) -> DataFrame:
    """AGG15: keyless ``reduce`` as a one-row aggregate."""
    return df.agg(*aggs)


def basic_statistics(df: DataFrame, x: str, y: str, digits: int = 4) -> DataFrame:
    """AGG18: count, means, population variances and correlation, one row."""
    r = lambda c: round_half_up(c, digits)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        r(F.avg(x)).alias(f"avg_{x}"),
        r(F.avg(y)).alias(f"avg_{y}"),
        r(F.var_pop(x)).alias(f"var_{x}"),
        r(F.var_pop(y)).alias(f"var_{y}"),
        r(F.stddev_samp(x)).alias(f"std_{x}"),
        r(F.min(x)).alias(f"min_{x}"),
        r(F.max(x)).alias(f"max_{x}"),
        r(F.corr(x, y)).alias(f"corr_{x}_{y}"),
    )


def combine_by_key(df: DataFrame, keys, value: str) -> DataFrame:
    """AGG16 ``combineByKey`` with the classic (sum, count) combiner -> mean.

    createCombiner / mergeValue / mergeCombiners map onto Spark's partial and
    final aggregation of ``sum`` and ``count``; no Python runs per row. The value is
    summed as money; for a combiner of one's own see ``combine.reduce_by_key``.
    """
    money = F.sum(F.col(value).cast("decimal(18,2)")).cast("decimal(38,2)")
    sums = df.groupBy(*_cols(keys)).agg(money.alias("sum_value"), F.count(value).alias("n"))
    return sums.withColumn("mean_value", round_half_up(F.col("sum_value").cast("double") / F.col("n")))
