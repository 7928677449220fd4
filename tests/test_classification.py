"""Classifiers and regression on several features against brute force and other solvers."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindling.operators import classification as cl
from kindling.operators.regression import sgd_gram, sgd_least_squares


def test_naive_bayes_matches_counting(spark, monkeypatch):
    monkeypatch.setattr(cl, "HOT_SHARE", 20)  # some tokens are hot, most are not
    rng = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(["The"] * 5 + [rng.choice(words[:40] if i % 2 else words[20:]) for _ in range(rng.randint(1, 30))])) for i in range(120)]
    docs += [(900, None), (901, ""), (902, " \t\n"), (903, "unseen words only"), (904, "the w1\x0bw2\tW3")]
    labels = [(i, i % 2) for i in range(80)] + [(900, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    counts = cl.token_counts(df, "doc_id", "text")
    model = cl.fit_naive_bayes(counts, spark.createDataFrame(labels, "doc_id long, y int"), "doc_id", "y")
    hot = {r.token for r in model.tokens.where("hot").collect()}
    assert "the" in hot and 0 < len(hot) <= 20
    got = {r.doc_id: (r.score, r.prediction) for r in cl.score_naive_bayes(model, df.select("doc_id"), counts, "doc_id").collect()}

    split = {i: (t or "").lower().split() for i, t in docs}
    by = [collections.Counter(w for i, y in labels if y == c for w in split[i]) for c in (0, 1)]
    known = set(by[0]) | set(by[1])
    size = [sum(b.values()) + len(known) for b in by]
    prior = math.log(sum(y for _, y in labels) / sum(1 - y for _, y in labels))
    for i, _ in docs:
        want = prior + sum(math.log((by[1][w] + 1) / size[1]) - math.log((by[0][w] + 1) / size[0]) for w in split[i] if w in known)
        assert got[i][0] == pytest.approx(want, abs=1e-9) and got[i][1] == (want > 0)
    assert len(got) == len(docs)


def test_naive_bayes_needs_both_classes(spark):
    counts = spark.createDataFrame([(1, "a", 1)], "doc_id long, token string, n long")
    with pytest.raises(ValueError):
        cl.fit_naive_bayes(counts, spark.createDataFrame([(1, 1)], "doc_id long, y int"), "doc_id", "y")


def brute_tree(rows, edges, depth, min_rows):
    """The greedy tree by trying every split on the rows themselves."""
    out, level = [], {1: rows}
    for _ in range(depth):
        below = {}
        for node, some in level.items():
            def half(part):
                p = sum(r[1] for r in part)
                return (p * p + (len(part) - p) ** 2) / len(part)

            best = None
            for f in sorted(edges):
                for b, e in enumerate(edges[f]):
                    left, right = ([r for r in some if (r[0][f] is not None and r[0][f] >= e) == side] for side in (False, True))
                    if len(left) < min_rows or len(right) < min_rows or half(left) + half(right) <= half(some) + 1e-9:
                        continue
                    if best is None or half(left) + half(right) > best[0] + 1e-9:
                        best = (half(left) + half(right), f, b, left, right)
            if best:
                _, f, b, left, right = best
                out.append((node, f, b, len(some), sum(r[1] for r in some), len(left), sum(r[1] for r in left)))
                below[2 * node], below[2 * node + 1] = left, right
        level = below
    return sorted(out)


def test_tree_matches_trying_every_split(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(400):
        a, b, c = rng.random(), rng.random(), rng.choice([None, rng.random()])
        rows.append(({"a": a, "b": b, "c": c}, int((a > 0.6) ^ (b > 0.3) if rng.random() > 0.05 else rng.random() > 0.5)))
    edges = {f: [i / 10 for i in range(1, 10)] for f in "abc"}
    df = spark.createDataFrame([(r["a"], r["b"], r["c"], y) for r, y in rows] + [(0.5, 0.5, 0.5, None)], "a double, b double, c double, y int")
    splits = cl.fit_tree(df, edges, "y", depth=3, min_rows=4)
    assert sorted((s.node, s.feature, s.bin, s.n, s.positive, s.left_n, s.left_positive) for s in splits) == brute_tree(rows, edges, 3, 4)
    ends = cl.leaves(splits, len(rows), sum(y for _, y in rows))
    scored = cl.predict_tree(splits, df, ends).where("y is not null")
    got = {r.node: (r.n, r.p) for r in scored.groupBy("node").agg(F.count("*").alias("n"), F.sum("y").alias("p")).collect()}
    assert got == ends
    assert scored.where("prediction = y").count() > 330


def test_tree_of_one_class_is_a_leaf(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1)], "a double, y int")
    assert cl.fit_tree(df, {"a": [1.5]}, "y") == []
    assert cl.predict_tree([], df, cl.leaves([], 2, 2)).where("prediction = 1 and node = 1").count() == 2


def test_svm_reaches_the_optimum(spark):
    rng = np.random.default_rng(3)
    x = np.c_[rng.normal(0, 1, 500), rng.normal(5, 20, 500), rng.normal(0, 0.1, 500)]
    y = (x[:, 0] + x[:, 1] / 20 + rng.normal(0, 0.7, 500) > 0.3).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y, strict=True)] + [(0.0, None, 0.0, None)], "a double, b double, c double, y int")
    model = cl.fit_svm(df, ["a", "b", "c"], "y", reg=0.02)
    z, sign = x / x.std(0, ddof=1), np.where(y == 1, 1.0, -1.0)

    def loss(w, b):
        return np.maximum(0, 1 - sign * (z @ w + b)).mean() + 0.01 * w @ w

    w, b, least = np.zeros(3), 0.0, 9.0
    for t in range(1, 60_001):  # plain subgradients
        short = sign * (z @ w + b) < 1
        w = w - 5 / t**0.75 * (0.02 * w - (z[short] * sign[short, None]).sum(0) / len(y))
        b = b + 5 / t**0.75 * sign[short].sum() / len(y)
        least = min(least, loss(w, b)) if t % 20 == 0 else least
    mine = loss(np.array(model.weights) * x.std(0, ddof=1), model.intercept)
    assert mine <= least + 6e-4 and model.passes < 80
    scored = cl.predict_svm(model, df)
    assert scored.count() == 501 and scored.where("prediction is null").count() == 0


def test_gram_recursion_matches_mllib(spark):
    from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD

    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (300, 3)) @ np.array([[1, 0.4, 0], [0, 1, 0.3], [0, 0, 1]])
    y = x @ [0.5, -1.0, 0.25] + rng.normal(0, 0.1, 300)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, y double")
    for iterations, tol in ((100, 0.001), (25, 0.0)):
        theirs = LinearRegressionWithSGD.train(df.rdd.map(lambda r: LabeledPoint(r.y, [r.a, r.b, r.c])), iterations=iterations, step=1.0, regParam=0.01,
                                               regType="l2", intercept=False, convergenceTol=tol)
        mine, steps = sgd_gram(df, ["a", "b", "c"], "y", iterations, 1.0, 0.01, tol)
        assert mine == pytest.approx(theirs.weights.toArray().tolist(), abs=1e-9) and 0 < steps <= iterations
    one, steps = sgd_gram(df, ["a"], "y")
    assert (one[0], steps) == pytest.approx(sgd_least_squares(df, "a", "y"))
    assert sgd_gram(df.limit(0), ["a", "b"], "y") == ([0.0, 0.0], 0)
