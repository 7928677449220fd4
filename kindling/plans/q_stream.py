"""Sliding-window hashtag counts and Structured Streaming queries (STR1-STR10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindling.functions.rounding import round_half_up
from kindling.plans.common import R4, T
from kindling.plans.fixtures import hashtag_events
from kindling.session import scratch_path
from kindling.sources.formats import read_json_stream, read_table_stream
from kindling.streaming.runner import latest, read_output, run_to_table, run_top_k
from kindling.streaming.windows import assign_windows, hashtags, sliding_counts, sliding_from_panes, top_of_latest_window

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Fixed values of the reference's stream: 300 s window sliding every second.
WINDOW_S, SLIDE_S = 300, 1
# The files of a stored table come in any order of event time, so these replays have no watermark:
# their state is one row per key and window, not per event. A run that drops late rows fails.
EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

_K = WINDOW_S // SLIDE_S
_SLIDING_SQL = f"""
WITH h AS (SELECT '#' || event_type AS tag, epoch_us(ts) // {SLIDE_S * 1_000_000} AS pane FROM events),
points AS (SELECT tag, pane FROM h UNION SELECT tag, pane + {_K} FROM h),
c AS (SELECT p.tag, p.pane, count(h.pane) AS n
      FROM points p LEFT JOIN h ON h.tag = p.tag AND h.pane <= p.pane AND h.pane > p.pane - {_K} GROUP BY 1, 2),
l AS (SELECT *, lead(pane) OVER (PARTITION BY tag ORDER BY pane) AS nxt FROM c)
SELECT tag, make_timestamp(CAST(pane * {SLIDE_S * 1_000_000} AS BIGINT)) AS valid_from,
       make_timestamp(CAST(nxt * {SLIDE_S * 1_000_000} AS BIGINT)) AS valid_to, CAST(n AS BIGINT) AS count
FROM l WHERE n > 0
"""


@register("hashtag_windows", _SLIDING_SQL)
def hashtag_windows(spark, sf):
    """STR2-STR3 in batch: all windows of every tag, as intervals of equal count."""
    return sliding_counts(hashtag_events(spark, sf), "ts", "tag", f"{WINDOW_S} seconds", f"{SLIDE_S} seconds")


@register("hashtag_top10_latest", f"""
SELECT '#' || event_type AS tag, count(*) AS count FROM events
WHERE ts >= (SELECT date_trunc('second', max(ts)) - INTERVAL {WINDOW_S - SLIDE_S} SECOND FROM events)
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""")
def hashtag_top10_latest(spark, sf):
    """STR4/STR5: the ten most frequent tags of the latest 300 s window."""
    return top_of_latest_window(hashtag_events(spark, sf), "ts", "tag", f"{WINDOW_S} seconds", f"{SLIDE_S} seconds", 10)


@register("document_hashtags_stream", r"""
WITH w AS (SELECT unnest(string_split(regexp_replace(text, '([^ \n]+)###', '#\1', 'g'), ' ')) AS tag FROM documents)
SELECT tag, count(*) AS count FROM w WHERE tag LIKE '#%' GROUP BY tag ORDER BY 2 DESC, 1 LIMIT 10
""")
def document_hashtags_stream(spark, sf):
    """STR2, STR4, STR5, FLT4, SNK6: documents as a message stream (words that
    end in ``###`` there are tags here, with one ``#`` before them) -> words ->
    words that start with ``#`` -> running counts; every batch ranks what it changed and
    the ten before it, and writes the first ten. The last batch's ten are the result."""
    docs = read_table_stream(spark, sf, "documents", "doc_id BIGINT, text STRING")
    docs = docs.withColumn("text", F.regexp_replace("text", r"([^ \n]+)###", "#$1"))
    counts = hashtags(docs, "text", "doc_id").groupBy(F.col("word").alias("tag")).agg(F.count(F.lit(1)).alias("count"))
    out = run_top_k(counts, "document-hashtags", "tag", "count", 10)
    rows = read_output(spark, out, "tag STRING, count BIGINT")
    last = rows.agg(F.max("batch_id")).first()[0]  # one number
    return rows.filter(F.col("batch_id") == last).select("tag", "count")


@register("events_hourly_windows", """
SELECT event_id, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end
FROM events
""")
def events_hourly_windows(spark, sf):
    """STR7 ``window``: every event tagged with its 1-hour window, no aggregation."""
    ev = T(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    out = assign_windows(ev, "ts", "1 hour")
    return out.select("event_id", F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window.end").cast("timestamp_ntz").alias("window_end"))


def _event_stream(spark, sf):
    ev = read_table_stream(spark, sf, "events", EVENTS_SCHEMA)
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


@register("hashtag_windows_stream", _SLIDING_SQL)
def hashtag_windows_stream(spark, sf):
    """STR1-STR7: file stream -> '#' tags -> 1 s pane counts kept in the state
    store (update mode) -> foreachBatch table ->
    300 s sliding sums over the panes. Equals the batch query."""
    ev = _event_stream(spark, sf)
    tags = ev.select("ts", F.concat(F.lit("#"), F.col("event_type")).alias("tag")).filter(F.col("tag").startswith("#"))
    panes = tags.groupBy("tag", F.window("ts", f"{SLIDE_S} seconds").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    panes = panes.select("tag", (F.unix_micros(F.col("w.start")) / F.lit(SLIDE_S * 1_000_000)).cast("bigint")
                         .alias("pane"), "n")
    out = run_to_table(panes, "hashtag_panes")
    merged = latest(read_output(spark, out, "tag STRING, pane BIGINT, n BIGINT"), ["tag", "pane"])
    return sliding_from_panes(merged, "tag", f"{WINDOW_S} seconds", f"{SLIDE_S} seconds")


@register("hourly_action_count_stream", """
SELECT event_type AS action, date_trunc('hour', ts) AS window_start,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS count
FROM events GROUP BY 1, 2, 3
""")
def hourly_action_count_stream(spark, sf):
    """STR10 / SRC18: JSON action logs (written by Spark from `events`) as a file
    stream, 1-hour tumbling count per action, merged from a foreachBatch sink."""
    logs = scratch_path(spark, "action-logs")
    T(spark, sf, "events").select(F.col("event_type").alias("action"),
                                  F.col("ts").cast("timestamp").alias("time")).write.json(logs)
    stream = read_json_stream(spark, logs, "action STRING, time TIMESTAMP")
    counts = stream.groupBy("action", F.window("time", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("count"))
    counts = counts.select("action", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "count")
    out = run_to_table(counts, "hourly-actions")
    merged = latest(read_output(spark, out, "action STRING, window_start TIMESTAMP, window_end TIMESTAMP, count BIGINT"),
                    ["action", "window_start"])
    return merged.select("action", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                         F.col("window_end").cast("timestamp_ntz").alias("window_end"), "count")


@register("windowed_total_stream", f"""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       {R4('sum(value)')} AS total
FROM events GROUP BY 1, 2
""")
def windowed_total_stream(spark, sf):
    """STR8 ``reduceByWindow``: keyless 1-hour windowed sum of `value`."""
    ev = _event_stream(spark, sf)
    tot = ev.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.sum("value").alias("total"))
    tot = tot.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total")
    out = run_to_table(tot, "hourly-total")
    merged = latest(read_output(spark, out, "window_start TIMESTAMP, window_end TIMESTAMP, total DOUBLE"),
                    ["window_start"])
    return merged.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                         F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                         round_half_up("total").alias("total"))


@register("running_count_stream", """
SELECT event_type, count(*) AS count FROM events GROUP BY event_type
""")
def running_count_stream(spark, sf):
    """STR9 ``updateStateByKey``: running count per key across batches (state
    store, update mode); the last update of each key is its final count."""
    ev = read_table_stream(spark, sf, "events", EVENTS_SCHEMA)
    counts = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))
    out = run_to_table(counts, "running-count")
    return latest(read_output(spark, out, "event_type STRING, count BIGINT"), ["event_type"])
