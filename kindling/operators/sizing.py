"""Size checks that guard every explicit broadcast.

A broadcast hint bypasses Spark's own size threshold, so we only hint a side
whose row count is *proven* small: either bounded by construction (a top-k) or
checked here by a bounded count that reads at most ``max_rows + 1`` rows.
Beyond the bound, the plain join is left to Catalyst/AQE (sort-merge or
shuffled hash, with AQE skew-join splitting).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest side (rows) we hint for broadcast; well under the 8 GB broadcast cap.
DEFAULT_BROADCAST_ROWS = 200_000
# Largest side (bytes, as measured by ``row_bytes``) we hint for broadcast.
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


def row_bytes(df: DataFrame) -> Column:
    """Approximate size of a row: each field's text form in bytes plus 8."""
    parts = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + F.lit(8) for c in df.columns]
    total = F.lit(0)
    for p in parts:
        total = total + p
    return total


def bounded_count(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> int | None:
    """The row count if it is at most ``max_rows`` and the rows' ``row_bytes``
    add up to at most ``max_bytes``, else ``None``.

    A collected limit runs Spark's incremental take: one partition first,
    then more only while fewer than ``max_rows + 1`` rows have been found.
    Proving a large table large therefore reads about ``max_rows`` rows,
    whereas ``limit(n).count()`` starts a task on every partition and each
    reads up to ``n`` rows. Only one size per row comes back, at most
    ``max_rows + 1`` integers.
    """
    sizes = df.select(row_bytes(df).alias("_b")).limit(max_rows + 1).collect()
    n = len(sizes)
    if n > max_rows or sum(r[0] for r in sizes) > max_bytes:
        return None
    return n


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``F.broadcast(df)`` when its size is proven small; otherwise ``df`` unchanged."""
    if max_rows <= 0:
        return df
    return F.broadcast(df) if bounded_count(df, max_rows) is not None else df


def spread(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the cluster when its scan yields fewer partitions
    than there are cores (e.g. one unsplittable row group feeding CPU-heavy
    per-row work). Large inputs already have more splits than cores and pass
    through unchanged, so this never adds a shuffle at scale. Meant for a
    scan: on a plan with shuffles, ``df.rdd`` would plan (under AQE, run) them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def pin_small(df: DataFrame) -> DataFrame:
    """Materialise a small, bounded frame (a top-k) once with a reliable
    checkpoint, so using it twice - as the result and as the broadcast key set
    that prunes a dimension - does not run its whole upstream twice."""
    return df.checkpoint()


def small_frame(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A DataFrame of a few driver-side rows (a result row, one offset per
    partition) planned as a ``LocalTableScan``: built through Arrow, so no
    Python worker is started to unpickle the rows."""
    import pandas as pd

    names = [f.name for f in spark.createDataFrame([], schema).schema.fields]
    pdf = pd.DataFrame.from_records(rows, columns=names) if rows else pd.DataFrame({n: [] for n in names})
    return spark.createDataFrame(pdf, schema)
