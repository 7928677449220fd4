"""Regression recursion, ALS output shape, and stream == batch for windows."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindling.operators.regression import sgd_least_squares
from kindling.operators import recommend as als
from kindling.operators import streamed_als
from kindling.operators.recommend import als_blocks, fit_als, recommend
from kindling.streaming.runner import latest, read_output, run_to_table
from kindling.streaming.windows import sliding_counts, sliding_from_panes


def test_sgd_matches_mllib(spark):
    from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD

    rnd = random.Random(1)
    pts = []
    for _ in range(300):
        x = rnd.gauss(0, 1)
        pts.append((x, -0.9 * x + rnd.gauss(0, 0.3)))
    df = spark.createDataFrame(pts, "x DOUBLE, y DOUBLE")
    w, steps = sgd_least_squares(df, "x", "y", 100, 1.0, 0.01, 0.001)
    rdd = spark.sparkContext.parallelize([LabeledPoint(y, [x]) for x, y in pts], 4)
    model = LinearRegressionWithSGD.train(rdd, iterations=100, step=1.0, miniBatchFraction=1.0,
                                          regParam=0.01, regType="l2", intercept=False)
    assert abs(model.weights[0] - w) < 1e-9
    assert 2 <= steps <= 100


def test_als_top10_per_user(spark):
    rnd = random.Random(2)
    data = [(u, i, float(rnd.randint(1, 5))) for u in range(30) for i in rnd.sample(range(40), 12)]
    r = spark.createDataFrame(data, "user BIGINT, item BIGINT, rating DOUBLE")
    recs = recommend(fit_als(r, max_iter=5), r.select("user").distinct(), 10).collect()
    by_user = {}
    for x in recs:
        by_user.setdefault(x["user"], []).append((x["rank"], x["item"], x["score"]))
    assert len(by_user) == 30
    for lst in by_user.values():
        lst.sort()
        assert len(lst) == 10 and len({i for _, i, _ in lst}) == 10
        assert all(a[2] >= b[2] for a, b in zip(lst, lst[1:]))


def test_als_blocks_follow_the_ratings_not_the_cores(spark, monkeypatch):
    # 40 ratings a user and 30 an item: four blocks however many cores there are, and however many users.
    assert [als_blocks(n * 600_000, n * 15_000, n * 20_000, cores) for n in (1, 60, 360) for cores in (2, 12, 1000)] == [2, 4, 4] * 3
    assert als_blocks(10**9, 10**8, 10**8, 1000) == 16  # a block holds its ratings
    assert als_blocks(10**7, 10**4, 10**3, 200) == 200  # many ratings a user: every core
    assert als_blocks(0, 0, 0, 8) == 4
    monkeypatch.setattr(als, "MIN_BLOCKS", 2)
    r = spark.range(400).selectExpr("id % 40 AS user", "id div 10 AS item", "id % 5 + 1.0 AS rating")
    fitted = fit_als(r, max_iter=2)
    assert fitted.model.userFactors.rdd.getNumPartitions() == 2
    assert fitted.model.userFactors.count() == 40 and fitted.model.itemFactors.count() == 40


def _factors(frame):
    return {x["id"]: np.array(x["features"], float) for x in frame.collect()}


def _loss(model, rated, reg=0.01):
    users, items = _factors(model.userFactors), _factors(model.itemFactors)
    return sum((users[u] @ items[i] - y) ** 2 + reg * (users[u] @ users[u] + items[i] @ items[i]) for u, i, y in rated), users, items


def test_streamed_als_fits_what_als_fits(spark, monkeypatch):
    rnd = random.Random(8)
    rated = [(u - 30, 3 * i, float(rnd.randint(1, 5))) for u in range(90) for i in rnd.sample(range(70), 1 + u % 25)]
    rated += [(u - 30, 7_000, float(u % 4)) for u in range(90)] + rated[:5]  # an item of many ratings; ratings that come twice
    r = spark.createDataFrame(rated, "user BIGINT, item BIGINT, rating DOUBLE")
    held, *_ = _loss(fit_als(r).model, rated)
    for name, value in (("SLICE_RATINGS", 60), ("BATCH", 16), ("SOLVED", 5), ("KEEP_EVERY", 3)):
        monkeypatch.setattr(streamed_als, name, value)
    monkeypatch.setattr(als, "HELD_RATINGS", 100)
    monkeypatch.setattr(als, "ALS", None)  # it would hold a block's ratings in a task
    fitted = fit_als(r)
    loss, users, items = _loss(fitted.model, rated)
    assert set(users) == {u for u, *_ in rated} and set(items) == {i for _, i, _ in rated}
    assert abs(loss / held - 1) < 0.25  # another start
    for user, found in users.items():  # solved last, so exactly the least squares against the items
        mine = [(items[i], y) for u, i, y in rated if u == user]
        x, y = np.array([x for x, _ in mine]), np.array([y for _, y in mine])
        assert np.allclose(np.linalg.solve(x.T @ x + 0.01 * len(mine) * np.eye(8), x.T @ y), found, rtol=1e-3, atol=1e-4)
    recs = recommend(fitted, r.where("user = 7").select("user").distinct(), 10).collect()
    assert sorted((x["rank"], x["item"]) for x in recs) == [(n, i) for n, i in enumerate(sorted(items, key=lambda i: -users[7] @ items[i])[:10], 1)]
    with pytest.raises(Exception, match="user Ids MUST NOT be Null"):
        fit_als(r.union(spark.sql("SELECT CAST(NULL AS BIGINT), 1L, 1.0D")))


def test_streamed_als_takes_texts_as_ids(spark, monkeypatch):
    monkeypatch.setattr(als, "HELD_RATINGS", 10)
    r = spark.range(400).selectExpr("concat('u', id % 40) AS user", "id div 10 + 5000000000 AS item", "id % 5 + 1.0 AS rating")
    recs = recommend(fit_als(r, max_iter=2), r.where("user = 'u7'").select("user").distinct(), 10).collect()
    assert {x["user"] for x in recs} == {"u7"} and len({x["item"] for x in recs}) == 10
    assert {x["item"] for x in recs} <= set(range(5_000_000_000, 5_000_000_040))


def test_streamed_blocks_bound_the_factors_that_a_task_holds():
    sizes = [(n * 600_000, n * 15_000, n * 20_000) for n in (1, 60, 360, 1800, 18_000)]
    blocks = [streamed_als.streamed_blocks(*x, 8, 4) for x in sizes]
    assert blocks[:3] == [4, 4, 4]
    for (ratings, users, items), b in zip(sizes, blocks, strict=True):
        for n in (users, items):
            assert 32 * n * (1 - (1 - 1 / b) ** (ratings / n)) <= streamed_als.FACTOR_BYTES
        assert b <= 4 or 32 * ratings / b > streamed_als.FACTOR_BYTES / 2  # no more than that takes


def test_stream_equals_batch_for_sliding_windows(spark, tmp_path):
    rnd = random.Random(5)
    base = 1_700_000_000
    rows = [(base + rnd.randint(0, 3600), "#" + rnd.choice("abc")) for _ in range(400)]
    rows.append((base + 600, "#edge"))  # exactly on a pane edge
    df = spark.createDataFrame(rows, "t BIGINT, tag STRING").select(
        F.timestamp_seconds("t").alias("ts"), "tag")
    src = os.path.join(tmp_path, "src")
    df.write.parquet(src)
    batch = sliding_counts(df, "ts", "tag", "300 seconds", "60 seconds")

    stream = spark.readStream.schema("ts TIMESTAMP, tag STRING").parquet(src).withWatermark("ts", "2 hours")
    panes = stream.groupBy("tag", F.window("ts", "60 seconds").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    panes = panes.select("tag", (F.unix_micros("w.start") / F.lit(60_000_000)).cast("bigint").alias("pane"), "n")
    out = run_to_table(panes, "test-panes", timeout_s=300)
    merged = latest(read_output(spark, out, "tag STRING, pane BIGINT, n BIGINT"), ["tag", "pane"])
    streamed = sliding_from_panes(merged, "tag", "300 seconds", "60 seconds")
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, streamed.collect()))


def test_empty_stream_gives_empty_table(spark, tmp_path):
    src = os.path.join(tmp_path, "empty")
    os.makedirs(src)
    stream = spark.readStream.schema("tag STRING").parquet(src)
    out = run_to_table(stream.groupBy("tag").count(), "test-empty", timeout_s=120)
    assert read_output(spark, out, "tag STRING, count BIGINT").count() == 0


def test_chunked_sliding_window_equals_brute_force(spark):
    from kindling.streaming.windows import sliding_from_panes

    rnd = random.Random(9)
    panes = sorted({(t, p) for t in "ab" for p in rnd.sample(range(0, 400), 60)})
    rows = [(t, p, rnd.randint(1, 5)) for t, p in panes]
    df = spark.createDataFrame(rows, "tag STRING, pane BIGINT, n BIGINT")
    # 7 panes per window, chunks of 2 windows: many chunk edges are crossed.
    got = {}
    for r in sliding_from_panes(df, "tag", 7, 1, chunk_windows=2).collect():
        zero = r["valid_from"].replace(year=1970, month=1, day=1, hour=0, minute=0, second=0)
        first, last = (int((r[c] - zero).total_seconds()) for c in ("valid_from", "valid_to"))
        for p in range(first, last):
            assert got.setdefault((r["tag"], p), r["count"]) == r["count"]
    counts = {(t, p): n for t, p, n in rows}
    want = {(t, p): sum(counts.get((t, q), 0) for q in range(p - 6, p + 1)) for t in "ab" for p in range(0, 420)}
    assert got == {k: n for k, n in want.items() if n}


def test_latest_top_ten_holds_every_tag_of_the_window(spark):
    import __spark_entry__ as entry

    top = entry.queries()["hashtag_top10_latest"](spark, "/root/testdata/sf0.1").collect()
    assert [tuple(r) for r in top] == [("#view", 4), ("#error", 3), ("#purchase", 3), ("#click", 1), ("#signup", 1)]


def test_stream_reads_a_folder_in_any_order_and_late_rows_fail(spark, tmp_path):
    from kindling.sources.formats import read_table_stream

    folder = os.path.join(tmp_path, "events.parquet")
    for day in (3, 2, 1):  # newest first, one file each
        spark.range(50).select(F.timestamp_seconds(F.lit(1_700_000_000 + day * 86400) + F.col("id")).alias("ts")).coalesce(1).write.mode("append").parquet(folder)
    stream = read_table_stream(spark, str(tmp_path), "events", "ts TIMESTAMP", max_files_per_trigger=1)
    out = run_to_table(stream.groupBy(F.window("ts", "1 hour").alias("w")).count().select("w.start", "count"), "test-order")
    merged = latest(read_output(spark, out, "start TIMESTAMP, count BIGINT"), ["start"])
    assert merged.agg(F.sum("count")).first()[0] == 150
    late = stream.withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 hour").alias("w")).count().select("w.start", "count")
    with pytest.raises(RuntimeError, match="later than the watermark"):
        run_to_table(late, "test-late")
    with pytest.raises(Exception, match="(?i)path.*not.*exist"):
        read_table_stream(spark, str(tmp_path), "absent", "ts TIMESTAMP")


def test_graph_loop_then_classifier_in_one_session(spark):
    """Loop operators must leave the session usable by ML models that hold it."""
    from kindling.operators.graph import bfs
    from kindling.operators.regression import text_classifier

    edges = spark.createDataFrame([(1, 2), (2, 3)], "src BIGINT, dst BIGINT")
    assert bfs(edges, 1, 3).count() == 3
    docs = spark.createDataFrame([(f"good text {i}", 1.0) for i in range(8)] + [(f"bad words {i}", 0.0) for i in range(8)],
                                 "text STRING, label DOUBLE")
    model = text_classifier(docs, "text", "label", max_iter=5)
    assert len(model.transform(docs).select("prediction").collect()) == 16
