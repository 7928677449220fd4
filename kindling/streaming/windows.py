"""Sliding and tumbling window counts (STR2-STR5, STR7, STR8, T5).

``F.window(ts, "300 seconds", "1 second")`` copies every row into 300
windows. The pane form avoids that: count per (key, slide-sized pane) first
(a partial aggregate), then sum the last ``window/slide`` panes with a range
frame. After pre-aggregation a key holds at most one row per pane, so the
window function's per-key work is bounded by the time span, not by the rows.
A window that slides every pane changes its count only where an event enters
or leaves it, so the table of its counts is kept as intervals between those
change points: complete, and at most two rows per pane that holds an event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _seconds(spec) -> int:
    if isinstance(spec, (int, float)):
        return int(spec)
    n, unit = spec.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
            "day": 86400, "days": 86400}[unit]
    return int(n) * mult


def pane_of(ts: Column, slide_s: int) -> Column:
    """Pane number: whole ``slide_s`` periods since the epoch (UTC)."""
    return F.floor(F.unix_micros(ts) / F.lit(slide_s * 1_000_000)).cast("bigint")


def pane_counts(df: DataFrame, ts: str, key: str, slide) -> DataFrame:
    """(key, pane, n): events per key and pane."""
    s = _seconds(slide)
    return df.groupBy(F.col(key), pane_of(F.col(ts), s).alias("pane")).agg(F.count(F.lit(1)).alias("n"))


def sliding_from_panes(panes: DataFrame, key: str, window, slide, value: str = "n", out: str = "count",
                       chunk_windows: int = 64) -> DataFrame:
    """The count of every sliding window as intervals ``(key, valid_from,
    valid_to, count)``: all windows that end after ``valid_from`` and not after
    ``valid_to`` hold ``count`` events, ``count`` > 0.

    A pane of ``n`` events adds ``n`` where it ends and takes it back one window
    later. The pane axis is cut into chunks of ``chunk_windows`` windows, and the
    window function runs per (key, chunk), so one busy key is spread over many
    tasks. Each chunk also gets the panes of the last window before it, which
    feed its sums and are then dropped, and the first change point after it.
    """
    w, s = _seconds(window), _seconds(slide)
    k = w // s
    size = max(k, chunk_windows * k)
    chunk = F.floor(F.col("pane") / size).cast("bigint")
    points = panes.select(key, "pane", value).unionByName(
        panes.select(key, (F.col("pane") + k).alias("pane"), F.lit(0).cast("bigint").alias(value)))
    points = points.groupBy(key, "pane").agg(F.sum(value).alias(value))
    own = points.select(key, "pane", value, chunk.alias("_chunk"), F.lit(False).alias("_ctx"))
    ctx = (
        points.filter(F.pmod(F.col("pane"), F.lit(size)) >= size - (k - 1))
        .select(key, "pane", value, (chunk + 1).alias("_chunk"), F.lit(True).alias("_ctx"))
    )
    line = Window.partitionBy(key, "_chunk").orderBy("pane")
    summed = own.unionByName(ctx).withColumn(out, F.sum(value).over(line.rangeBetween(-(k - 1), 0)))
    summed = summed.withColumn("_next", F.lead("pane").over(line)).filter(~F.col("_ctx"))
    firsts = points.groupBy(key, chunk.alias("_chunk")).agg(F.min("pane").alias("_first"))
    firsts = firsts.select(key, "_chunk", F.lead("_first").over(Window.partitionBy(key).orderBy("_chunk")).alias("_after"))
    summed = summed.join(firsts, [key, "_chunk"]).withColumn("_next", F.coalesce("_next", "_after")).filter(F.col(out) > 0)
    return summed.select(
        key,
        F.timestamp_seconds(F.col("pane") * s).cast("timestamp_ntz").alias("valid_from"),
        F.timestamp_seconds(F.col("_next") * s).cast("timestamp_ntz").alias("valid_to"),
        F.col(out).cast("bigint").alias(out),
    )


def sliding_counts(df: DataFrame, ts: str, key: str, window="300 seconds", slide="1 second") -> DataFrame:
    """STR3 in batch: pane form of a sliding-window count per key."""
    return sliding_from_panes(pane_counts(df, ts, key, slide), key, window, slide)


def top_of_latest_window(df: DataFrame, ts: str, key: str, window="300 seconds", slide="1 second", k: int = 10,
                         out: str = "count") -> DataFrame:
    """STR4/STR5: the ``k`` most frequent keys (ties by key) of the latest
    window: one aggregate finds its end, a filter on ``ts`` keeps its events."""
    w, s = _seconds(window), _seconds(slide)
    last = df.agg(pane_of(F.max(ts), s).alias("last")).first()["last"]
    if last is None:
        return df.groupBy(key).agg(F.count(F.lit(1)).alias(out)).limit(0)
    start = F.timestamp_seconds(F.lit((last + 1) * s - w))
    return df.filter(F.col(ts) >= start).groupBy(key).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), F.asc(key)).limit(k)


def tumbling(df: DataFrame, ts: str, size: str, keys=(), value: str | None = None, out: str = "count") -> DataFrame:
    """STR8/STR10: tumbling-window count (or sum of ``value``) per key."""
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    g = df.groupBy(*keys, F.window(ts, size).alias("w")).agg(agg.alias(out))
    return g.select(*keys, F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), out)


def assign_windows(df: DataFrame, ts: str, window: str, slide: str | None = None) -> DataFrame:
    """STR7 ``window``: re-window rows without aggregating (one row per window
    a row falls in; use a slide equal to the window to avoid copies)."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    return df.select("*", w.alias("window"))


def hashtags(df: DataFrame, text: str, ts: str) -> DataFrame:
    """STR2 / FLT4: words of a message stream that start with ``#``."""
    from kindling.functions.text import java_split

    words = df.select(F.col(ts), F.explode(java_split(F.col(text), " ")).alias("word"))
    return words.filter(F.col("word").startswith("#"))
