"""Streams with per-key state, incremental windows and late rows (STR3, STR7, STR9).

``events`` arrive out of order here: each row up to three hours after its time, by a
rule on its id; in the query on late rows, one in fifty two days after that. Arrivals are cut into slices, one micro-batch each.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kindling.plans.common import T
from kindling.plans.q_stream import _SLIDING_SQL, SLIDE_S, WINDOW_S
from kindling.streaming.runner import read_output
from kindling.streaming.state import Activity, WindowRing, activity, replay, run_stateful, window_ring

QUERIES = {}
ORACLE = {}

SLICES, DELAY_S, SILENCE_S, BEHIND_S = 4, 10_800, 4 * 3600, 172_800


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _arrivals(spark, sf, name, behind_s=0):
    ev = T(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    delay = F.pmod(F.col("event_id") * 7919, F.lit(DELAY_S)) + F.when(F.pmod("event_id", F.lit(50)) == 7, behind_s).otherwise(0)
    return replay(spark, ev, "ts", F.unix_micros("ts") + delay * 1_000_000, SLICES, name)


def _time(col):
    return F.timestamp_micros(col).cast("timestamp_ntz")


@register("hashtag_windows_incremental_stream", _SLIDING_SQL)
def hashtag_windows_incremental_stream(spark, sf):
    """STR3 ``reduceByKeyAndWindow`` with its inverse, inside the stream: events that arrive out of
    order, counts of all 300 s windows that slide by 1 s, each change added or taken back as the watermark passes it."""
    ev = _arrivals(spark, sf, "ring-events")
    tags = ev.select("kind", "ts", F.concat(F.lit("#"), F.col("event_type")).alias("tag"))
    out = run_stateful(window_ring(tags, "tag", "ts", WINDOW_S, SLIDE_S, f"{DELAY_S} seconds"), "ring")
    rows = read_output(spark, out, WindowRing.output).where(F.col("kind") == "window")
    return rows.select(F.col("key").alias("tag"), _time(F.col("valid_from") * (SLIDE_S * 1_000_000)).alias("valid_from"),
                       _time(F.col("valid_to") * (SLIDE_S * 1_000_000)).alias("valid_to"), F.col("n").alias("count"))


_ARRIVED_SQL = f"""
WITH a AS (SELECT *, epoch_us(ts) AS us, epoch_us(ts) + ((event_id * 7919) % {DELAY_S} + CASE WHEN event_id % 50 = 7 THEN {BEHIND_S} ELSE 0 END) * 1000000 AS arrived FROM events),
b AS (SELECT min(arrived) AS begin_us, max(arrived) - min(arrived) + 1 AS span FROM a),
s AS (SELECT a.*, (arrived - begin_us) * {SLICES} // span AS slice FROM a, b),
m AS (SELECT slice, max(us) AS top FROM s GROUP BY slice),
w AS (SELECT s.*, coalesce(us < (SELECT max(top) // 1000 * 1000 FROM m WHERE m.slice < s.slice) - {DELAY_S * 1_000_000}, false) AS late FROM s)
"""


@register("hourly_counts_with_late_stream", f"""{_ARRIVED_SQL}
SELECT CASE WHEN late THEN 'late' ELSE 'window' END AS kind, event_type, date_trunc('hour', ts) AS window_start, count(*) AS count
FROM w GROUP BY ALL
""")
def hourly_counts_with_late_stream(spark, sf):
    """STR7 and event time: hourly counts in append mode under a watermark of three hours; rows that come
    later go to their own table. On time and late together are the input."""
    ev = _arrivals(spark, sf, "hourly-events", BEHIND_S)
    out = run_stateful(window_ring(ev, "event_type", "ts", 3600, 3600, f"{DELAY_S} seconds", row_id="event_id", parts=8), "hourly-late")
    rows = read_output(spark, out, WindowRing.output)
    start = F.when(F.col("kind") == "late", F.date_trunc("hour", F.timestamp_micros("us"))).otherwise(F.timestamp_seconds(F.col("valid_from") * 3600))
    rows = rows.where(F.col("kind").isin("window", "late"))
    return rows.groupBy("kind", F.col("key").alias("event_type"), start.cast("timestamp_ntz").alias("window_start")).agg(F.sum("n").alias("count"))


def _activity(spark, sf):
    ev = _arrivals(spark, sf, "activity-events")
    out = run_stateful(activity(ev, "user_id", "ts", "event_id", "value", SILENCE_S, f"{DELAY_S} seconds"), "activity")
    return read_output(spark, out, Activity.output)


_RUNS_SQL = f"""
WITH g AS (SELECT *, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER u AS before, lag(value) OVER u AS before_value
           FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, coalesce(us - before > {SILENCE_S * 1_000_000}, true) AS starts FROM g),
n AS (SELECT *, sum(starts::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM r)
"""


@register("activity_gaps_stream", f"""{_RUNS_SQL}
SELECT event_id, user_id, CASE WHEN NOT starts THEN us - before END AS gap_us, CASE WHEN NOT starts THEN before_value END AS previous_value,
       row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS position
FROM n
""")
def activity_gaps_stream(spark, sf):
    """STR9 ``updateStateByKey``: every event of a user with the time since the one before it and
    that one's value, within a run of activity. No plain aggregate keeps these."""
    rows = _activity(spark, sf).where(F.col("kind") == "event")
    return rows.select(F.col("id").alias("event_id"), F.col("key").cast("bigint").alias("user_id"), (F.col("us") - F.col("previous_us")).alias("gap_us"),
                       "previous_value", "position")


@register("activity_expiry_stream", f"""{_RUNS_SQL}
SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, arg_max(value, (us, event_id)) AS last_value, count(*) AS events FROM n GROUP BY user_id, run
""")
def activity_expiry_stream(spark, sf):
    """STR9 with timers: a user's run of activity comes out, and the user's state goes, when four hours of silence have passed."""
    rows = _activity(spark, sf).where(F.col("kind") == "expired")
    return rows.select(F.col("key").cast("bigint").alias("user_id"), _time("first_us").alias("first_ts"), _time("us").alias("last_ts"),
                       F.col("value").alias("last_value"), F.col("position").alias("events"))
