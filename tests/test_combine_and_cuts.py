"""User combiners, similarity with cuts, last duplicates of files, ids beyond 32 bits, one partitioning for two uses."""

import collections
import math
import os
import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from kindling.operators.combine import reduce_by_key
from kindling.operators.recommend import dense_ids, fit_als, recommend
from kindling.operators.similarity import pair_stats, prune_ratings, top_pairs
from kindling.sources.delimited import read_friend_counts, read_items_last
from tests.conftest import explain_text, rows


@pytest.mark.parametrize("held_keys", [100_000, 7])
def test_user_combiner_merges_all_rows_of_a_key(spark, held_keys):
    rng = random.Random(1)
    data = [(rng.choice(["hot"] * 20 + [None] + [f"k{i}" for i in range(30)]), rng.randrange(3), rng.randrange(1, 10**6) * 6, f"w{rng.randrange(50)}") for _ in range(3000)]
    df = spark.createDataFrame(data, "a string, b int, n long, w string").repartition(5)

    def merge(x, y):  # greatest common divisor, and the shortest word, first of equal ones: no built-in aggregates
        return math.gcd(x[0], y[0]), min(x[1], y[1], key=lambda w: (len(w), w))

    got = rows(reduce_by_key(df, ["a", "b"], ["n", "w"], merge, held_keys))
    by = collections.defaultdict(list)
    for a, b, n, w in data:
        by[a, b].append((n, w))
    assert {r[:2]: r[2:] for r in got} == {k: reduce(merge, v) for k, v in by.items()} and len(got) == len(by)
    assert reduce_by_key(df.limit(0), ["a"], ["n"], lambda x, y: x).count() == 0


def test_user_combiner_shuffles_partial_rows(spark):
    df = spark.range(100_000, numPartitions=4).select(F.lit("hot").alias("k"), F.lit(1).cast("long").alias("n"))
    out = reduce_by_key(df, ["k"], ["n"], lambda x, y: (x[0] + y[0],))
    assert rows(out) == [("hot", 100_000)]
    plan = explain_text(out)
    assert plan.count("MapInArrow") >= 2 and plan.index("MapInArrow") < plan.index("Exchange")


def _skewed_ratings():
    rng = random.Random(2)
    return sorted({(u, int(rng.random() ** 3 * 60)) for u in range(80) for _ in range(12)})


def _pair_rows(r):
    per = collections.Counter(u for u, _ in r)
    return sum(n * (n - 1) // 2 for n in per.values())


def test_pruning_is_exact_and_cuts_the_self_join(spark):
    rng = random.Random(3)
    r = [(u, i, float(rng.randrange(1, 6))) for u, i in _skewed_ratings()]
    df = spark.createDataFrame(r, "user int, item int, rating double")
    for min_n in (3, 9):
        whole = {(p.item_i, p.item_j): (p.n, round(p.sxy, 6)) for p in pair_stats(df).where(F.col("n") > min_n).collect()}
        kept = prune_ratings(df, min_n)
        less = {(p.item_i, p.item_j): (p.n, round(p.sxy, 6)) for p in pair_stats(kept).where(F.col("n") > min_n).collect()}
        assert less == whole and whole
        assert _pair_rows([(x.user, x.item) for x in kept.collect()]) < _pair_rows([x[:2] for x in r])


def test_top_pairs_match_brute_force(spark):
    rng = random.Random(4)
    r = [(u, i, float(rng.randrange(1, 6))) for u, i in _skewed_ratings()]
    names = spark.createDataFrame([(i, f"item {i}") for i in range(55)], "id int, title string")  # some have no name
    got = [tuple(x) for x in top_pairs(spark.createDataFrame(r, "user int, item int, rating double"), 0.85, 4, 10, names, "id", "title").collect()]
    by = collections.defaultdict(dict)
    for u, i, x in r:
        by[i][u] = x
    want = []
    for i in by:
        for j in by:
            both = by[i].keys() & by[j].keys()
            if i < j and len(both) > 4:
                s = sum(by[i][u] * by[j][u] for u in both) / math.sqrt(sum(by[i][u] ** 2 for u in both) * sum(by[j][u] ** 2 for u in both))
                if s > 0.85:
                    want.append((i, j, math.floor(s * 1e4 + 0.5) / 1e4, len(both), *(f"item {k}" if k < 55 else None for k in (i, j))))
    want.sort(key=lambda p: (-p[2], -p[3], p[0], p[1]))
    assert len(want) > 10 and sorted(got) == sorted(want[:10])


def test_last_row_of_an_id_wins(spark, tmp_path):
    folder = tmp_path / "items"
    os.makedirs(folder)
    rng = random.Random(5)
    last = {}
    for name in ("b.psv", "a.psv", "c.psv"):  # written in another order than their names have
        with open(folder / name, "wb") as f:
            for n in range(2000):
                i = rng.randrange(300)
                f.write(b"%d|%s %d Caf\xe9|x|y\n" % (i, name.encode(), n) if n % 50 else b"%d\n" % i)
    for name in ("a.psv", "b.psv", "c.psv"):
        for line in (folder / name).read_bytes().decode("utf-8", "replace").splitlines():
            parts = line.split("|")
            if len(parts) > 1:
                last[int(parts[0])] = parts[1]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("7000", before):  # several blocks a file, and whole files
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert dict(rows(read_items_last(spark, str(folder)))) == last
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_friend_counts(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_bytes(b"0,Oda,51,17\r\n1,Per-Ivar,19,240\r\n")
    assert rows(read_friend_counts(spark, str(path))) == [("Oda", 17), ("Per-Ivar", 240)]


def test_ids_beyond_32_bits_and_texts_are_recommended(spark):
    rng = random.Random(6)
    r = [(u, i, float(1 + (u * i) % 5)) for u in range(12) for i in range(15) if rng.random() < 0.7]
    plain = spark.createDataFrame(r, "user long, item long, rating double")
    far = plain.select((F.col("user") + 2**40).alias("user"), F.concat(F.lit("i"), F.lpad(F.col("item").cast("string"), 3, "0")).alias("item"), "rating")
    a, b = (recommend(fit_als(x, max_iter=4, num_blocks=2), x.select("user").distinct(), 4) for x in (plain, far))
    assert {x.user for x in b.collect()} == {u + 2**40 for u, *_ in r}
    assert {x.item for x in b.collect()} <= {f"i{i:03}" for i in range(15)}
    # Dense ids keep the ids' order and these ids are dense already, so both fits see the same numbers.
    assert {(x.user + 2**40, f"i{x.item:03}", x["rank"]) for x in a.collect()} == {(x.user, x.item, x["rank"]) for x in b.collect()}
    book = dense_ids(spark.createDataFrame([(7,), (None,), (2**50,), (7,), (-3,)], "v long"), "v")
    assert rows(book) == [(-3, 0), (7, 1), (2**50, 2)]


def test_one_partitioning_serves_the_means_and_the_join(spark):
    from kindling.plans.q_similarity import rating_deviation

    plan = explain_text(rating_deviation(spark, "/root/testdata/sf0.001"), "simple")
    by_user = [x for x in plan.splitlines() if "Exchange hashpartitioning(user" in x]
    assert by_user and not any("ENSURE_REQUIREMENTS" in x for x in by_user), plan


def test_prune_ratings_joins_only_when_something_goes(spark):
    df = spark.createDataFrame([(u, i, 1.0) for u in range(4) for i in range(3)], "user int, item int, rating double")
    whole = explain_text(prune_ratings(df, 3), "extended")
    assert "Filter" in whole and "Join" not in whole  # the given rows, not joined, shuffled or written again
    assert prune_ratings(df, 3).count() == 12 and prune_ratings(df, 4).count() == 0
