"""Set operations (SET1-SET4) with RDD semantics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*dfs: DataFrame) -> DataFrame:
    """SET1 ``union``: bag union, duplicates kept, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET2 ``intersection``: distinct rows present in both."""
    return a.intersect(b)


def subtract_bag(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET3 / T6: RDD ``subtract`` keeps *every* copy of a left row absent from b.

    A null-safe left-anti join on all columns (not ``exceptAll``, not ``subtract``).
    """
    # Distinct right rows first (partial dedup): a hot right row becomes one row.
    b = b.distinct()
    cond = [a[c].eqNullSafe(b[c]) for c in a.columns]
    return a.join(b, cond, "left_anti")


def distinct(df: DataFrame) -> DataFrame:
    """SET4: distinct rows (partial dedup before the shuffle)."""
    return df.distinct()
