"""Item-item similarity against a brute-force computation, with and without salting."""

import math
import random

import pytest

from kindling.operators.similarity import item_similarity, pair_stats, similar_items


def _ratings(seed=7):
    rnd = random.Random(seed)
    out = []
    for u in range(40):
        n = 30 if u == 0 else rnd.randint(1, 8)  # user 0 is a heavy user
        for i in rnd.sample(range(35), n):
            out.append((u, i, float(rnd.randint(1, 5))))
    return out


def _brute(r):
    by_user = {}
    for u, i, x in r:
        by_user.setdefault(u, {})[i] = x
    acc = {}
    for items in by_user.values():
        for i in items:
            for j in items:
                if i < j:
                    a = acc.setdefault((i, j), [0.0, 0.0, 0.0, 0])
                    a[0] += items[i] ** 2
                    a[1] += items[j] ** 2
                    a[2] += items[i] * items[j]
                    a[3] += 1
    return {k: (v[2] / (math.sqrt(v[0]) * math.sqrt(v[1])), v[3]) for k, v in acc.items()}


@pytest.mark.parametrize("heavy_rows", [5000, 4])
def test_pair_stats_exact_with_and_without_salting(spark, heavy_rows):
    r = _ratings()
    df = spark.createDataFrame(r, "user BIGINT, item BIGINT, rating DOUBLE")
    got = {(x["item_i"], x["item_j"]): (x["score"], x["n"]) for x in item_similarity(df, heavy_rows=heavy_rows).collect()}
    want = _brute(r)
    assert set(got) == set(want)
    for k, (s, n) in want.items():
        assert got[k][1] == n and abs(got[k][0] - s) < 1e-12


def test_salting_spreads_heavy_user(spark):
    r = _ratings()
    df = spark.createDataFrame(r, "user BIGINT, item BIGINT, rating DOUBLE")
    assert pair_stats(df, heavy_rows=4).count() == len(_brute(r))


def test_similar_items_equals_filtered_all_pairs(spark):
    r = _ratings()
    df = spark.createDataFrame(r, "user BIGINT, item BIGINT, rating DOUBLE")
    want = sorted(
        ((j if i == 3 else i), s, n) for (i, j), (s, n) in _brute(r).items() if 3 in (i, j) and s > 0.5 and n > 1
    )
    want = sorted(want, key=lambda t: (-t[1], -t[2], t[0]))[:10]
    got = [(x["other"], x["score"], x["n"]) for x in similar_items(df, 3, 0.5, 1, 10).collect()]
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(abs(g[1] - w[1]) < 1e-12 for g, w in zip(got, want))


def test_pairs_are_not_shuffled(spark):
    from conftest import explain_text

    df = spark.createDataFrame(_ratings(), "user BIGINT, item BIGINT, rating DOUBLE")
    assert "hashpartitioning(item_i" not in explain_text(item_similarity(df))


def test_pairs_of_many_groups_with_nulls_repeats_and_text_ids(spark, monkeypatch):
    from kindling.operators import baskets

    r = _ratings(9) + [(5, 3, None), (6, 3, None), (7, None, 1.0), (None, 3, 1.0), (None, 4, 1.0), (8, 2, 4.0), (8, 2, 5.0), (8, 1, 2.0)]
    want = {}
    for u, i, x in r:
        for v, j, y in r:
            if None not in (u, i, j) and u == v and i < j:
                s = want.setdefault((i, j), [None, None, None, 0])
                for k, z in enumerate((x and x * x, y and y * y, x and y and x * y)):
                    s[k] = s[k] if z is None else (s[k] or 0.0) + z
                s[3] += 1
    df = spark.createDataFrame(r, "user BIGINT, item BIGINT, rating DOUBLE")
    named = df.selectExpr("concat('u', user) AS user", "concat('i', lpad(item, 3, '0')) AS item", "rating")
    for small in (False, True):
        if small:
            monkeypatch.setattr(baskets, "PAIRS_PER_GROUP", 50)
            monkeypatch.setattr(baskets, "LAID_OUT", 40)
            monkeypatch.setattr(baskets, "PACKED", 30)
        assert {(p[0], p[1]): list(p[2:]) for p in pair_stats(df, heavy_rows=20 if small else 5000).collect()} == want
    assert {(int(p[0][1:]), int(p[1][1:])): list(p[2:]) for p in pair_stats(named).collect()} == want
    assert {tuple(p[:2]) for p in pair_stats(df, min_n=3).collect()} == {k for k, s in want.items() if s[3] >= 3}
