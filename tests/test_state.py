"""Per-key stream state: window rings and runs of activity, on fakes of the store and on streams of several batches."""

import collections
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from kindling.session import scratch_path
from kindling.streaming.runner import read_output, run_top_k
from kindling.streaming.state import Activity, WindowRing, activity, run_stateful, window_ring


class Store:
    """A value state, timers and a watermark for one key."""

    def __init__(self):
        self.value, self.timers, self.mark_ms, self.largest = None, set(), 0, 0

    def getValueState(self, *_):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.largest = value, max(self.largest, len(value[0]))

    def clear(self):
        self.value = None

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)

    def getCurrentWatermarkInMs(self):
        return self.mark_ms


def drive(processor, key, batches, delay_us):
    """Runs batches of (us, id, value) through a processor as Spark would: input, then timers, then the watermark moves."""
    store, out, top = Store(), [], 0
    processor.init(store)
    end = [(10**15, None, None)]
    for rows in [*batches, end, []]:
        frame = pd.DataFrame({"kind": ["end" if r[1] is None else "event" for r in rows], "us": [r[0] for r in rows], "id": [r[1] for r in rows],
                              "value": [r[2] for r in rows], "n": 1}).astype({"us": "int64"})
        if rows:
            out += [f for f in processor.handleInputRows(key, iter([frame]), store)]
        for ms in sorted(store.timers):
            if ms <= store.mark_ms and ms in store.timers:
                store.timers.remove(ms)
                out += [f for f in processor.handleExpiredTimer(key, store, None)]
        top = max([top, *[r[0] for r in rows]])
        store.mark_ms = max(0, (top - delay_us) // 1000)
    return pd.concat(out, ignore_index=True), store


def shuffled_batches(rng, n, span_us, delay_us, count):
    events = [(rng.randrange(span_us), i, float(i % 7)) for i in range(n)]
    arrivals = sorted(events, key=lambda e: e[0] + rng.randrange(delay_us))
    return events, [b.tolist() for b in np.array_split(np.array(arrivals, object), count)]


def test_ring_equals_counting_every_window():
    rng = random.Random(1)
    for window, slide in ((300, 1), (60, 20), (50, 50)):
        events, batches = shuffled_batches(rng, 400, 20_000_000_000, 900_000_000, 7)
        got, store = drive(WindowRing(window, slide), ("k", 0), batches, 900_000_000)
        k = window // slide
        panes = collections.Counter(us // (slide * 10**6) for us, *_ in events)
        want = {p + i: sum(panes[p + i - j] for j in range(k)) for p in panes for i in range(k)}
        closed = {p: int(r.n) for r in got[got.kind == "window"].itertuples() for p in range(r.valid_from, r.valid_to)}
        assert closed == want and not (got.kind == "late").any()
        # A key whose windows are empty is forgotten; the state holds a window and the delay, not the stream.
        assert store.value is None and not store.timers and got[got.kind == "current"].n.iloc[-1] == 0
        assert store.largest < 400


def test_ring_takes_late_rows_out():
    rng = random.Random(2)
    events, batches = shuffled_batches(rng, 300, 10_000_000_000, 900_000_000, 5)
    late = [(5, 900, 0.0), (7, 901, 0.0)]
    got, _ = drive(WindowRing(100, 100), ("k", 0), [*batches[:3], late, *batches[3:]], 900_000_000)
    assert sorted(got[got.kind == "late"].id) == [900, 901]
    assert got[got.kind == "window"].n.sum() == len(events)


def runs(events, silence_us):
    out, previous = [], None
    for us, i, v in sorted(events, key=lambda e: e[:2]):
        if previous is None or us - previous[0] > silence_us:
            out.append([])
        out[-1].append((i, us, v, *((previous[0], previous[2]) if out[-1] else (None, None)), len(out[-1]) + 1))
        previous = (us, i, v)
    return out


def test_activity_equals_sorting_all_events():
    rng = random.Random(3)
    events, batches = shuffled_batches(rng, 300, 20_000_000_000, 500_000_000, 6)
    ties = [(events[0][0], 1001, 2.5), (events[0][0], 1000, 1.5)]
    events += ties
    next(b for b in batches if any(e[1] == 0 for e in b)).extend(ties)
    got, store = drive(Activity(60), ("k",), batches, 500_000_000)
    late = set(got[got.kind == "late"].id)
    want = runs([e for e in events if e[1] not in late], 60_000_000)
    columns = ["id", "us", "value", "previous_us", "previous_value", "position"]
    found = [tuple(None if pd.isna(x) else x for x in r) for r in got[got.kind == "event"][columns].itertuples(index=False, name=None)]
    assert found == [r for run in want for r in run]
    ends = [tuple(r) for r in got[got.kind == "expired"][["first_us", "us", "value", "position"]].itertuples(index=False, name=None)]
    assert ends == [(run[0][1], run[-1][1], run[-1][2], len(run)) for run in want]
    assert store.value is None and not store.timers and not late


def _write(spark, folder, rows):
    spark.createDataFrame(rows, "event_id long, us long, tag string, value double, kind string").select(
        "event_id", F.timestamp_micros("us").alias("ts"), "tag", "value", "kind").coalesce(1).write.mode("append").parquet(folder)


END = (None, 10**16, None, None, "end")
SCHEMA = "event_id long, ts timestamp, tag string, value double, kind string"


def test_stream_goes_on_from_its_checkpoint(spark):
    """Files out of order, one key with most rows, a restart between the batches; on time and late make the input."""
    rng = random.Random(4)
    base = 1_700_000_000_000_000
    events, batches = shuffled_batches(rng, 600, 5_000_000_000, 300_000_000, 4)
    rows = [[(int(i), base + int(us), "hot" if i % 3 else f"t{i % 5}", v, "event") for us, i, v in b] for b in batches]
    rows[3].append((9000, base - 10**9, "hot", 0.0, "event"))  # long past
    folder, ring_out, act_out = (scratch_path(spark, n) for n in ("in", "ring-out", "act-out"))
    for i, part in enumerate([*rows, [END]]):
        _write(spark, folder, part)
        if i in (1, 2, 4):  # three runs; each one goes on where the last ended, a file a batch
            src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
            run_stateful(window_ring(src, "tag", "ts", 60, 60, "300 seconds", row_id="event_id", parts=4), "ring", ring_out)
            run_stateful(activity(src, "tag", "ts", "event_id", "value", 30, "300 seconds"), "act", act_out)
    ring = read_output(spark, ring_out, WindowRing.output)
    assert ring.select("batch_id").distinct().count() > 4
    late = ring.where("kind = 'late'").collect()
    assert [r.id for r in late] == [9000]
    counts = {(r.key, r.valid_from): r.n for r in ring.where("kind = 'window'").groupBy("key", "valid_from").agg(F.sum("n").alias("n")).collect()}
    flat = [r for part in rows for r in part if r[0] != 9000]
    assert counts == collections.Counter((r[2], r[1] // 60_000_000) for r in flat)
    assert sum(counts.values()) + len(late) == sum(map(len, rows))
    act = read_output(spark, act_out, Activity.output)
    want = [(tag, *r) for tag in {r[2] for r in flat} for run in runs([(r[1], r[0], r[3]) for r in flat if r[2] == tag], 30_000_000) for r in run]
    got = act.where("kind = 'event'").select("key", "id", "us", "value", "previous_us", "previous_value", "position").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_combined_panes_equal_single_rows(spark):
    folder = scratch_path(spark, "combined-in")
    base, rng = 1_700_000_000_000_000, random.Random(6)
    rows = [(i, base + rng.randrange(10**9), "hot" if i % 4 else None, 1.0, "event") for i in range(3000)]
    _write(spark, folder, rows)
    _write(spark, folder, [END])
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    out = read_output(spark, run_stateful(window_ring(src, "tag", "ts", 100, 10, "10 seconds"), "combined"), WindowRing.output)
    closed = {(r.key, p): r.n for r in out.where("kind = 'window'").collect() for p in range(r.valid_from, r.valid_to)}
    want = collections.Counter((r[2], r[1] // 10**7 + i) for r in rows for i in range(10))
    assert closed == want


def test_top_k_needs_only_the_last_ten(spark):
    folder = scratch_path(spark, "words")
    rng = random.Random(8)
    batches = [[(f"w{int(rng.random() ** 2 * 40)}",) for _ in range(300)] for _ in range(4)]
    for b in batches:
        spark.createDataFrame(b, "word string").coalesce(1).write.mode("append").parquet(folder)
    src = spark.readStream.schema("word string").option("maxFilesPerTrigger", 1).parquet(folder)
    out = run_top_k(src.groupBy("word").agg(F.count(F.lit(1)).alias("count")), "top", "word", "count", 5)
    got = collections.defaultdict(list)
    for r in read_output(spark, out, "word string, count long").collect():
        got[r.batch_id].append((r.word, r["count"]))
    seen = collections.Counter()
    for i, b in enumerate(batches):
        seen.update(w for w, in b)
        assert sorted(got[i], key=lambda r: (-r[1], r[0])) == sorted(seen.items(), key=lambda r: (-r[1], r[0]))[:5]


def test_activity_of_many_keys_takes_a_call_a_group():
    """The keys of a group share a state, its timer and its calls; each comes out as if it were alone."""
    rng = random.Random(11)
    events, batches = shuffled_batches(rng, 900, 20_000_000_000, 500_000_000, 6)
    name = {i: None if i % 9 == 8 else f"k{i % 9}" for i in range(900)}
    store, calls, out, top, processor = Store(), 0, [], 0, Activity(60)
    processor.init(store)
    for rows in [*batches, [(10**15, None, None)], []]:
        if rows:
            frame = pd.DataFrame({"kind": ["end" if r[1] is None else "event" for r in rows], "key": [name.get(r[1]) for r in rows], "us": [r[0] for r in rows],
                                  "id": [r[1] for r in rows], "value": [None if r[1] is None or r[1] % 50 == 0 else r[2] for r in rows]}).astype({"us": "int64"})
            out, calls = out + list(processor.handleInputRows((0,), iter([frame]), store)), calls + 1
        for ms in sorted(store.timers):
            if ms <= store.mark_ms:
                store.timers.remove(ms)
                out, calls = out + list(processor.handleExpiredTimer((0,), store, None)), calls + 1
        top = max([top, *[r[0] for r in rows]])
        store.mark_ms = max(0, (top - 500_000_000) // 1000)
    got = pd.concat(out, ignore_index=True)
    assert store.value is None and not store.timers and not (got.kind == "late").any() and calls < 20
    for key in set(name.values()):
        mine = got[got.key.isna() if key is None else got.key == key]
        want = runs([(us, i, None if i % 50 == 0 else v) for us, i, v in events if name[i] == key], 60_000_000)
        found = [tuple(None if pd.isna(x) else x for x in r) for r in mine[mine.kind == "event"][["id", "us", "value", "previous_us", "previous_value", "position"]].itertuples(index=False, name=None)]
        assert found == [r for run in want for r in run]
        ends = [tuple(None if pd.isna(x) else x for x in r) for r in mine[mine.kind == "expired"][["first_us", "us", "value", "position"]].itertuples(index=False, name=None)]
        assert sorted(ends) == [(run[0][1], run[-1][1], run[-1][2], len(run)) for run in want]
