"""Aggregates, lookups, set operations and scalar helpers on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from kindling.functions.scalar import fixed_2dp, int_div, safe_div, tenths_celsius_to_fahrenheit
from kindling.operators import aggregates as agg
from kindling.operators.lookup import anti_join, cogroup_sizes, dedup_dimension, lookup_names
from kindling.operators.setops import distinct, intersect_distinct, subtract_bag, union_all
from kindling.operators.topk import top_k
from tests.conftest import explain_text, rows


def test_avg_div_truncates_toward_zero(spark):
    df = spark.createDataFrame([(1, -7), (1, 0), (2, 5), (3, 3), (3, 4)], "k INT, v INT")
    # k=1: -7 div 2 = -3 (not -4); group of one; 7 div 2 = 3
    assert rows(agg.avg_div_by_key(df, "k", "v")) == [(1, -3), (2, 5), (3, 3)]


def test_safe_div_and_int_div_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 2.0)], "a DOUBLE, b DOUBLE")
    assert [r[0] for r in df.select(safe_div("a", "b")).collect()] == [0.0, 1.5]
    df2 = spark.createDataFrame([(7, 0)], "a BIGINT, b BIGINT")
    assert df2.select(int_div("a", "b").alias("q")).first()["q"] is None


def test_temperature_text(spark):
    df = spark.createDataFrame([(-148,), (0,)], "v INT")
    out = df.select(fixed_2dp(tenths_celsius_to_fahrenheit("v"), " F").alias("t")).collect()
    assert [r["t"] for r in out] == ["5.36 F", "32.00 F"]


def test_count_by_value_string_keys(spark):
    df = spark.createDataFrame([(10,), (9,), (10,)], "v INT")
    assert rows(agg.count_by_value(df, "v", key_type="string")) == [("10", 2), ("9", 1)]


def test_partial_aggregation_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = explain_text(agg.sum_by_key(df, "k", "v"))
    assert "partial_sum" in plan


def test_lookup_missing_modes(spark):
    facts = spark.createDataFrame([(1,), (2,), (None,)], "k INT")
    dim = spark.createDataFrame([(1, "one"), (3, "three")], "k INT, name STRING")
    assert rows(lookup_names(facts, dim, "k"), "k", "name") == [(1, "one"), (2, None), (None, None)]
    assert rows(lookup_names(facts, dim, "k", on_missing="drop"), "k", "name") == [(1, "one")]
    with pytest.raises(Exception):
        lookup_names(facts, dim, "k", on_missing="error").collect()
    # small fact side: dimension streamed against broadcast keys
    assert rows(lookup_names(facts, dim, "k", df_max_rows=3, on_missing="drop"), "k", "name") == [(1, "one")]


def test_duplicate_dimension_ids(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "k INT, name STRING")
    assert rows(dedup_dimension(dim, "k", "name")) == [(1, "b")]


def test_anti_join_and_bag_subtract(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "w STRING")
    b = spark.createDataFrame([("y",), (None,)], "w STRING")
    assert rows(anti_join(a, b, "w")) == [("x",), ("x",), (None,)]  # plain key anti-join keeps null
    assert rows(subtract_bag(a, b)) == [("x",), ("x",)]            # null-safe, duplicates kept


def test_union_intersect_distinct(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v INT")
    b = spark.createDataFrame([(2,), (3,)], "v INT")
    assert rows(union_all(a, b)) == [(1,), (1,), (2,), (2,), (3,)]
    assert rows(intersect_distinct(a, b)) == [(2,)]
    assert rows(distinct(a)) == [(1,), (2,)]


def test_cogroup_sizes(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k INT")
    b = spark.createDataFrame([(2,), (3,)], "k INT")
    assert rows(cogroup_sizes(a, b, "k")) == [(1, 2, 0), (2, 1, 1), (3, 0, 1)]


def test_top_k_ties_broken_by_key(spark):
    df = spark.createDataFrame([(3, 5), (1, 5), (2, 5), (4, 1)], "k INT, c INT")
    assert [r["k"] for r in top_k(df, "c", 2, tiebreak=["k"]).collect()] == [1, 2]
    assert "TakeOrderedAndProject" in explain_text(top_k(df, "c", 2, tiebreak=["k"]))


def test_broadcast_only_under_proven_bound(spark):
    from kindling.operators.sizing import bounded_count, broadcast_if_small

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no automatic broadcast
    try:
        big = spark.range(1000).withColumnRenamed("id", "k")
        small = spark.range(5).withColumnRenamed("id", "k")
        assert bounded_count(small, 10) == 5 and bounded_count(small, 4) is None
        hinted = explain_text(big.join(broadcast_if_small(small, 10), "k"))
        assert "BroadcastHashJoin" in hinted
        plain = explain_text(big.join(broadcast_if_small(small, 4), "k"))
        assert "BroadcastHashJoin" not in plain and "SortMergeJoin" in plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_top_k_lookup_streams_dimension_against_broadcast_keys(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(100).select((F.col("id") % 7).alias("k"))
        top = top_k(agg.count_by_key(facts, "k"), "count", 3, tiebreak=["k"])
        dim = spark.range(10000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
        out = lookup_names(top, dim, "k", df_max_rows=3)
        plan = explain_text(out)
        # the dimension is never hash-shuffled: it is probed against broadcast top-k keys
        assert "BroadcastHashJoin" in plan
        assert "SortMergeJoin" not in plan
        assert sorted(r["k"] for r in out.collect()) == [0, 1, 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_outer_join_rewrite_equals_plain_join(spark):
    from kindling.operators.lookup import outer_join

    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n"), (2, "b2")], "k INT, lv STRING")
    # Key 2 is hot on the right; key 4 has no left row; a null key never matches.
    right = spark.createDataFrame([(2, 10.0)] * 6 + [(1, 1.0), (4, 4.0), (None, 0.0)], "k INT, rv DOUBLE")
    for how in ("left", "right", "full", "inner"):
        for hot_rows in (1, 1000):  # 1: key 2 leaves the outer join; 1000: no key is hot
            got = outer_join(left, right, "k", how, hot_rows=hot_rows)
            want = left.join(right, "k", how)
            assert got.columns == want.columns, (how, hot_rows)
            assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr), (how, hot_rows)


def test_outer_join_deals_a_hot_key(spark):
    from kindling.operators.lookup import hot_keys, outer_join

    # Keys 7 (right), 8 (left, absent on the right) and 9 (both sides) are hot; the rows of a key are alike.
    left = spark.createDataFrame([(7, "a"), (7, "b"), (1, "c"), (None, "n")] + [(8, "h")] * 40 + [(9, "x")] * 30, "k INT, lv STRING")
    right = spark.createDataFrame([(7, 1.0)] * 40 + [(2, 2.0), (None, 3.0)] + [(9, 5.0)] * 30 + [(6, 6.0)] * 35, "k INT, rv DOUBLE")
    assert rows(hot_keys(left, "k", 20)) == [(8,), (9,)] and rows(hot_keys(right, "k", 20)) == [(6,), (7,), (9,)]
    assert hot_keys(left, "k", 40) is None
    for how in ("left", "right", "full"):
        got, want = outer_join(left, right, "k", how, hot_rows=20), left.join(right, "k", how)
        assert got.columns == want.columns
        assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr), how
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        met = outer_join(left, right, "k", "left", hot_rows=20).where("k = 9")  # 900 rows, 112 in an even share of 8
        sizes = [r["count"] for r in met.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 900 and max(sizes) < 600
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_cogroup_rows_are_runs_in_order(spark):
    from kindling.operators.lookup import cogroup_rows

    left = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (None, "n", 0)], "k INT, v STRING, side INT")
    right = spark.createDataFrame([(2, i % 3) for i in range(50)] + [(3, 9)], "k INT, w INT")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = cogroup_rows(left, right, "k", ["v"], ["w"])
        found = [(r["k"], r["side"], (r["left"] or r["right"])[0]) for r in got.collect()]  # in the order of the partitions
        spread = got.where("k = 2").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = [(None, "left", "n"), (1, "left", "a"), (2, "left", "b")] + [(2, "right", i) for i in sorted(i % 3 for i in range(50))]
    assert found == want + [(3, "right", 9)] and spread > 1


def test_top_k_lookup_takes_one_row_of_a_repeated_id(spark):
    top = spark.createDataFrame([(1, 5), (2, 3)], "k INT, n INT")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (3, "c")], "k INT, name STRING")
    assert rows(lookup_names(top, dim, "k", df_max_rows=2), "k", "name", "n") == [(1, "b", 5), (2, None, 3)]


def test_bounded_count_across_many_partitions(spark):
    from pyspark.sql import functions as F

    from kindling.operators.sizing import bounded_count

    df = spark.range(0, 1000, 1, 50)
    assert bounded_count(df, 1000) == 1000 and bounded_count(df, 999) is None
    sparse = df.filter(F.col("id") % 97 == 0)  # 11 rows spread over many partitions
    assert bounded_count(sparse, 11) == 11 and bounded_count(sparse, 10) is None
    assert bounded_count(df.filter("id < 0"), 0) == 0


def test_bounded_count_checks_bytes(spark):
    from pyspark.sql import functions as F

    from kindling.operators.sizing import bounded_count

    wide = spark.range(4).select("id", F.repeat(F.lit("x"), 100_000).alias("s"))  # ~400 KB in all
    assert bounded_count(wide, 10) == 4
    assert bounded_count(wide, 10, max_bytes=300_000) is None


def test_arithmetic_survives_scale(spark):
    from kindling.functions.rounding import hundredths_text, round_half_up

    d = 400_000_000_000_007
    df = spark.createDataFrame([(25 * d, d), (-7, 2), ((1 << 62) + 1, 1)], "n BIGINT, d BIGINT")
    assert [r["q"] for r in df.select(int_div("n", "d").alias("q")).collect()] == [25, -3, (1 << 62) + 1]
    vals = spark.createDataFrame([(2.3e16,), (1.5e300,), (-5.36,), (-0.05,), (0.125,)], "v DOUBLE")
    assert [r["r"] for r in vals.select(round_half_up("v").alias("r")).collect()] == [2.3e16, 1.5e300, -5.36, -0.05, 0.125]
    small = vals.filter("abs(v) < 10")
    assert [r["t"] for r in small.select(hundredths_text("v", " F").alias("t")).collect()] == ["-5.36 F", "-0.05 F", "0.13 F"]


def test_pregel_reads_edge_columns_and_an_initial_message(spark):
    from kindling.operators.graph import pregel

    edges = spark.createDataFrame([(1, 2, 5.0), (1, 3, 1.0), (3, 2, 1.0)], "src BIGINT, dst BIGINT, weight DOUBLE")
    verts = spark.createDataFrame([(1, 0.0), (2, 99.0), (3, 99.0), (4, 99.0)], "id BIGINT, attr DOUBLE")
    out = pregel(verts, edges, F.col("src_attr") + F.col("weight"), "min", initial=50.0)
    assert rows(out, "id", "attr") == [(1, 0.0), (2, 2.0), (3, 1.0), (4, 50.0)]


def test_edges_partitioned_by_source_are_not_shuffled_again(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)], "src BIGINT, dst BIGINT").repartition("src").checkpoint()
    front = spark.range(5).select(F.col("id").alias("src"))
    text = explain_text(edges.join(front.hint("merge"), "src"))
    assert text.count("Exchange hashpartitioning") + text.count("hashpartitioning(src") <= 3
