"""Sorts and top-k (SRT1-SRT7).

The reference leaves ties unordered; we always append the key columns as a
tie-break so a cut at ``k`` is deterministic. ``orderBy(...).limit(k)`` plans
as ``TakeOrderedAndProject``: each task keeps its own k best rows, so no
global sort and no skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(by, ascending: bool) -> list[Column]:
    cols = [by] if isinstance(by, (str, Column)) else list(by)
    out = []
    for c in cols:
        c = F.col(c) if isinstance(c, str) else c
        out.append(c.asc() if ascending else c.desc())
    return out


def sort_by(df: DataFrame, by, ascending: bool = True, tiebreak=()) -> DataFrame:
    """SRT1/SRT2/SRT5: total order on ``by`` then ``tiebreak`` ascending."""
    return df.orderBy(*_order(by, ascending), *_order(tiebreak, True))


def top_k(df: DataFrame, by, k: int, ascending: bool = False, tiebreak=()) -> DataFrame:
    """SRT3/SRT4/SRT6: the first ``k`` rows in that order."""
    return sort_by(df, by, ascending, tiebreak).limit(k)
