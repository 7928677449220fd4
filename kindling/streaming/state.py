"""Streams with state of their own per key (STR3, STR7, STR9).

Two processors for ``transformWithStateInPandas``. ``WindowRing`` keeps one value per key in the
RocksDB store, ``Activity`` one per group of keys; both move on event time alone (the watermark fires their timers)
and take rows that come later than the watermark out of the result instead of
dropping them: the event time reaches them as plain microseconds, so Spark
tracks the watermark but leaves the late rows in, and they come out with the
kind ``late``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kindling.session import scratch_path
from kindling.streaming.runner import run_to_table
from kindling.streaming.windows import _seconds

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of this kind move the watermark past the end of a replay and take part in nothing else.
END_KIND = "end"
#: States that the keys of :func:`activity` are dealt over, and rows of a replay's slice to a file.
KEY_GROUPS, FILE_ROWS = 256, 500_000


def _watermark_us(timers) -> int:
    return 1000 * timers.getCurrentWatermarkInMs()


class _Timed(StatefulProcessor):
    """One value per state and one event-time timer, which the value remembers."""

    schema: str

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.schema)

    def close(self) -> None:
        pass

    def wake_at(self, old_ms: int, new_ms: int) -> None:
        if old_ms != new_ms:
            if old_ms:
                self.handle.deleteTimer(old_ms)
            self.handle.registerTimer(new_ms)


class WindowRing(_Timed):
    """Counts of sliding windows with an inverse function, per key.

    The state is the ring of the changes ahead: an event adds 1 in its pane and
    takes it back one window later; with it go the count so far and the point of
    the last change. When the watermark passes a change it is applied, and the count
    before it comes out as an interval. A key whose changes have all been
    applied has the count 0 and is forgotten, so the state holds the panes of one window and of the
    watermark's delay, whatever the length of the stream.
    """

    schema = "points array<bigint>, changes array<bigint>, running bigint, last bigint, timer bigint"
    output = "key string, part int, kind string, valid_from bigint, valid_to bigint, n bigint, id bigint, us bigint"

    def __init__(self, window_s: int, slide_s: int):
        self.panes, self.slide_us = window_s // slide_s, slide_s * 1_000_000

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = _watermark_us(timerValues)
        new = pd.concat(list(rows), ignore_index=True) if rows else pd.DataFrame()
        new = new[new["kind"] != END_KIND]
        late = new["us"].to_numpy() < mark
        if late.any():
            gone = new[late]
            yield self._frame(key, "late", len(gone), n=gone["n"].to_numpy(), id=gone["id"].to_numpy(), us=gone["us"].to_numpy())
        new = new[~late]
        if len(new):
            pane, n = new["us"].to_numpy() // self.slide_us, new["n"].to_numpy()
            yield from self._move(key, mark, np.concatenate((pane, pane + self.panes)), np.concatenate((n, -n)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._move(key, _watermark_us(timerValues), np.empty(0, np.int64), np.empty(0, np.int64), fired=True)

    def _frame(self, key, kind: str, rows: int, **columns) -> pd.DataFrame:
        out = {"key": [key[0]] * rows, "part": np.full(rows, key[1], np.int32), "kind": [kind] * rows}
        for name in ("valid_from", "valid_to", "n", "id", "us"):
            out[name] = pd.array(columns.get(name, [None] * rows), dtype="Int64")
        return pd.DataFrame(out)

    def _move(self, key, mark: int, points: np.ndarray, changes: np.ndarray, fired: bool = False) -> Iterator[pd.DataFrame]:
        held = self.state.get()
        running, last, timer = (held[2], held[3], held[4]) if held else (0, 0, 0)
        if held:
            points, changes = np.concatenate((points, held[0])), np.concatenate((changes, held[1]))
        points, at = np.unique(points.astype(np.int64), return_inverse=True)
        changes = np.bincount(at, weights=changes, minlength=len(points)).astype(np.int64)
        due = int(np.searchsorted(points, mark // self.slide_us))  # panes before the watermark's are complete
        if due:
            counts = running + np.concatenate(([0], np.cumsum(changes[:due])))
            starts = np.concatenate(([last], points[:due]))
            shown = np.flatnonzero(counts[:-1] > 0)
            if len(shown):
                yield self._frame(key, "window", len(shown), valid_from=starts[shown], valid_to=starts[shown + 1], n=counts[shown])
            running, last = int(counts[-1]), int(starts[-1])
            # The window as it stands now: what a ranking of the latest window reads.
            yield self._frame(key, "current", 1, valid_from=[last], n=[running])
        points, changes = points[due:], changes[due:]
        if not len(points):
            self.state.clear()
            return
        wake = (int(points[0]) + 1) * self.slide_us // 1000
        self.wake_at(0 if fired else timer, wake)
        self.state.update((points.tolist(), changes.tolist(), running, last, wake))


class Activity(_Timed):
    """Per key the last value, the time since it, and the end of activity.

    Events wait in the state until the watermark has passed them, then come out in order of (time, id) with the value
    and the time before them. A key that stays silent for ``silence_s`` expires by the
    timer: its run comes out with its first and last event, and the key is forgotten.

    A state holds the keys of one group (the column ``key`` of the rows; without it the state's own key), each with
    its waiting events and its run, and the timer wakes for the next of them. All due events are taken in columns, so the
    cost of a call is not paid for every key.
    """

    schema = "keys array<string>, waiting binary, running binary, timer bigint"
    output = ("key string, kind string, id bigint, us bigint, value double, previous_us bigint, previous_value double, position bigint, first_us bigint")
    #: A waiting event; ``key`` is the place of its key in the state, a null value is NaN.
    event = np.dtype([("key", "i8"), ("us", "i8"), ("id", "i8"), ("no_id", "?"), ("value", "f8")])
    #: The run of a key that has one (``n`` events), in the order of the keys.
    run = np.dtype([("first", "i8"), ("last", "i8"), ("value", "f8"), ("n", "i8")])

    def __init__(self, silence_s: int):
        self.silence_us = silence_s * 1_000_000

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = _watermark_us(timerValues)
        new = pd.concat(list(rows), ignore_index=True)
        new = new[new["kind"] != END_KIND]
        names = new["key"].where(new["key"].notna(), None).tolist() if "key" in new else [key[0]] * len(new)
        events = np.zeros(len(new), self.event)
        events["us"], events["no_id"] = new["us"].to_numpy(), new["id"].isna()
        events["id"], events["value"] = new["id"].fillna(0).to_numpy(), new["value"].astype("float64").to_numpy()
        late = events["us"] < mark
        if late.any():
            gone = events[late]
            yield self._frame([n for n, x in zip(names, late, strict=True) if x], "late", id=(gone["id"], gone["no_id"]), us=gone["us"], value=gone["value"])
        if not late.all():
            yield from self._move(mark, [n for n, x in zip(names, late, strict=True) if not x], events[~late])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._move(_watermark_us(timerValues), [], np.empty(0, self.event), fired=True)

    @staticmethod
    def _frame(keys: list, kind: str, **columns) -> pd.DataFrame:
        """A column is an array, or one with the mask of its nulls; NaN is null too."""
        out, nothing = {"key": keys, "kind": [kind] * len(keys)}, np.ones(len(keys), bool)
        for c in ("id", "us", "value", "previous_us", "previous_value", "position", "first_us"):
            values, null = x if isinstance(x := columns.get(c, (np.zeros(len(keys)), nothing)), tuple) else (x, ~nothing)
            if c in ("value", "previous_value"):
                out[c] = pd.arrays.FloatingArray(values.astype("float64"), null | np.isnan(values))
            else:
                out[c] = pd.arrays.IntegerArray(values.astype("int64"), null.copy())
        return pd.DataFrame(out)

    def _move(self, mark: int, names: list, new: np.ndarray, fired: bool = False) -> Iterator[pd.DataFrame]:
        held = self.state.get()
        place = {k: i for i, k in enumerate(held[0])} if held else {}
        known, timer = len(place), held[3] if held else 0
        new["key"] = [place.setdefault(k, len(place)) for k in names]
        keys, waiting, running = np.array([*place, None], object)[:-1], new, np.zeros(len(place), self.run)
        if held:
            waiting = np.concatenate((new, np.frombuffer(held[1], self.event)))
            running[:known] = np.frombuffer(held[2], self.run)
        is_due = waiting["us"] < mark
        due, waiting = waiting[is_due], waiting[~is_due]
        if len(due):
            due = due[np.lexsort((due["id"], due["us"], due["key"]))]
            key, us, value = due["key"], due["us"], due["value"]
            at, begins = np.arange(len(due)), np.append(True, key[1:] != key[:-1])
            before = running[key]  # what a key's first event goes on from
            follows = ~begins | (before["n"] > 0)
            previous_us = np.where(begins, before["last"], np.roll(us, 1))
            previous_value = np.where(begins, before["value"], np.roll(value, 1))
            starts = ~follows | (us - previous_us > self.silence_us)
            head = np.maximum.accumulate(np.where(begins | starts, at, 0))  # the first of these events in each one's run
            goes_on = (begins & ~starts)[head]
            n = at - head + 1 + np.where(goes_on, before["n"], 0)
            first = np.where(goes_on, before["first"], us[head])
            yield self._frame(keys[key].tolist(), "event", id=(due["id"], due["no_id"]), us=us, value=value, previous_us=(previous_us, starts),
                              previous_value=(previous_value, starts), position=n, first_us=first)
            ends = starts & follows
            if ends.any():
                run_n, run_first = np.where(begins, before["n"], np.roll(n, 1)), np.where(begins, before["first"], np.roll(first, 1))
                yield self._frame(keys[key[ends]].tolist(), "expired", us=previous_us[ends], value=previous_value[ends], position=run_n[ends], first_us=run_first[ends])
            last = np.append(begins[1:], True)
            for c, x in (("first", first), ("last", us), ("value", value), ("n", n)):
                running[c][key[last]] = x[last]
        silent = (running["n"] > 0) & (running["last"] + self.silence_us < mark)  # no event that is still to come can be near enough
        if silent.any():
            gone = running[silent]
            yield self._frame(keys[silent].tolist(), "expired", us=gone["last"], value=gone["value"], position=gone["n"], first_us=gone["first"])
            running[silent] = 0
        kept = running["n"] > 0
        active = running[kept]
        kept[waiting["key"]] = True
        if not kept.any():
            self.state.clear()
            return
        wake = int(min([*waiting["us"].min(initial=2**62).reshape(1), *(active["last"].min(initial=2**61) + self.silence_us).reshape(1)])) // 1000 + 1
        self.wake_at(0 if fired else timer, wake)
        waiting["key"] = (np.cumsum(kept) - 1)[waiting["key"]]
        self.state.update((keys[kept].tolist(), waiting.tobytes(), running[kept].tobytes(), wake))


def _combined(rows: DataFrame, slide_us: int) -> DataFrame:
    """Rows of one key and pane become one with their number, batch by batch,
    before they are shuffled, so a key that has most of the events sends its panes. Late rows then come out by pane."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            pane = np.floor_divide(t["us"].to_numpy(), slide_us) * slide_us
            t = t.set_column(t.schema.get_field_index("us"), "us", pa.array(pane, pa.int64()))
            n = t.group_by(["key", "part", "kind", "us"]).aggregate([("n", "sum")])
            out = pa.table([n["key"], n["part"], n["kind"], pa.nulls(len(n), pa.int64()), n["us"], n["n_sum"]], names=["key", "part", "kind", "id", "us", "n"])
            yield from out.combine_chunks().to_batches()

    return rows.mapInArrow(run, "key string, part int, kind string, id bigint, us bigint, n bigint")


def window_ring(stream: DataFrame, key: str, ts: str, window, slide, delay: str, row_id: str | None = None, parts: int = 1) -> DataFrame:
    """STR3/STR7 on a stream: the counts of all sliding windows of each key, added to and taken from incrementally.

    ``key``, ``part``, ``kind`` and microseconds or panes (whole slides since the epoch): ``window`` rows
    are intervals (``valid_from``, ``valid_to``, ``n``) that no later event can change, ``current`` rows the latest
    count of a key, ``late`` rows came more than ``delay`` behind the greatest event time.
    With ``row_id`` late rows come out one by one with that id; without it rows are
    combined by pane before the shuffle. ``parts`` spreads each key over that many states (by row id); a window's counts
    are then to be added up, which is right for windows that do not overlap. With
    a slide equal to the window this is the tumbling count in append mode."""
    s = _seconds(slide)
    kind = F.col("kind") if "kind" in stream.columns else F.lit("event")
    part = F.pmod(F.xxhash64(row_id), F.lit(parts)).cast("int") if parts > 1 else F.lit(0)
    rows = stream.withWatermark(ts, delay).select(
        F.col(key).cast("string").alias("key"), part.alias("part"), kind.alias("kind"), (F.col(row_id) if row_id else F.lit(None)).cast("bigint").alias("id"),
        F.unix_micros(ts).alias("us"), F.lit(1).cast("bigint").alias("n"))
    if not row_id:
        rows = _combined(rows, s * 1_000_000)
    return rows.groupBy("key", "part").transformWithStateInPandas(WindowRing(_seconds(window), s), WindowRing.output, "Append", "EventTime")


def activity(stream: DataFrame, key: str, ts: str, row_id: str, value: str, silence, delay: str, groups: int = KEY_GROUPS) -> DataFrame:
    """STR9: each event of a key with the value and time of the event before it (``event`` rows), the runs of activity
    that ``silence`` ends (``expired`` rows), and ``late`` rows. The keys are dealt over ``groups`` states."""
    kind = F.col("kind") if "kind" in stream.columns else F.lit("event")
    rows = stream.withWatermark(ts, delay).select(
        F.col(key).cast("string").alias("key"), kind.alias("kind"), F.col(row_id).cast("bigint").alias("id"),
        F.unix_micros(ts).alias("us"), F.col(value).cast("double").alias("value"))
    rows = rows.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int"))
    return rows.groupBy("group").transformWithStateInPandas(Activity(_seconds(silence)), Activity.output, "Append", "EventTime")


def run_stateful(stream: DataFrame, name: str, folder: str | None = None) -> str:
    """:func:`run_to_table` with the RocksDB state store, which per-key state needs; other queries keep the session's store."""
    conf, setting = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(setting)
    conf.set(setting, ROCKSDB)
    try:
        return run_to_table(stream, name, output_mode="append", folder=folder)
    finally:
        conf.set(setting, before)


def replay(spark: SparkSession, rows: DataFrame, ts: str, arrival_us, slices: int, name: str) -> DataFrame:
    """``rows`` as a stream in the order of their arrival: ``slices`` equal spans of ``arrival_us``
    are written one after the other, in as many files each as the smallest has ``FILE_ROWS``, and read one slice a batch; a last
    row of the kind ``end``, ten years on, lets the watermark pass all others."""
    folder = scratch_path(spark, name)
    timed = rows.withColumn("kind", F.lit("event")).withColumn("_at", arrival_us)
    (first, last), files = timed.agg(F.min("_at"), F.max("_at")).first(), 1
    if first is not None:
        span = last - first + 1
        ends = [first + -(-span * i // slices) for i in range(slices + 1)]
        spans = [(F.col("_at") >= low) & (F.col("_at") < high) for low, high in zip(ends[:-1], ends[1:], strict=True)]
        files = max(1, min(timed.agg(*map(F.count_if, spans)).first()) // FILE_ROWS)
        for within in spans:
            part = timed.where(within).drop("_at")
            part.repartition(files).write.mode("append").parquet(folder)
        # A date far ahead moves the watermark past every window and silence.
        end = timed.agg(F.max(ts).alias("end")).select(*[
            (F.col("end") + F.expr("INTERVAL 3650 DAYS") if c == ts else F.lit(END_KIND) if c == "kind" else F.lit(None)).cast(kind).alias(c)
            for c, kind in timed.drop("_at").dtypes])
        end.repartition(1).write.mode("append").parquet(folder)
    else:
        timed.drop("_at").write.mode("append").parquet(folder)
    return spark.readStream.schema(timed.drop("_at").schema).option("maxFilesPerTrigger", files).parquet(folder)
