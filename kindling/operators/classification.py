"""Classifiers (ML1): multinomial naive Bayes, a decision tree, a linear support vector machine.

All are aggregates and joins: no rows reach the driver, only counts by bin, splits, and sums of a few dozen numbers.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A token that makes up at least 1 / HOT_SHARE of all tokens is hot: there are at most HOT_SHARE of them.
HOT_SHARE = 10_000


def token_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, token, n): tokens between white space, A-Z lower-cased, counted per row of ``df``."""
    words = F.explode(F.split(F.translate(text, UPPER, LOWER), r"[ \t\n\x0b\f\r]+"))
    return df.select(key, words.alias("token")).where(F.col("token") != "").groupBy(key, "token").agg(F.count(F.lit(1)).alias("n"))


@dataclass
class NaiveBayes:
    """``tokens``: per token seen in training its smoothed ``weight``, the log of
    P(token | 1) / P(token | 0), and whether it is ``hot``; ``prior``: the log odds of the classes."""

    tokens: DataFrame
    prior: float


def fit_naive_bayes(counts: DataFrame, labels: DataFrame, key: str, label: str, smoothing: float = 1.0) -> NaiveBayes:
    """Multinomial naive Bayes for a 0/1 label from (key, token, n) and (key, label): class and token counts in
    one aggregate by token, so a frequent token is one partial row a task.

    Hot tokens are found over all rows, as scoring joins them all."""
    y = F.col(label)
    per = counts.join(labels, key, "left").groupBy("token").agg(
        F.sum("n").alias("all"), *(F.coalesce(F.sum(F.when(y == c, F.col("n"))), F.lit(0)).alias(f"n{c}") for c in (0, 1)))
    per = per.checkpoint()
    seen = (F.col("n0") + F.col("n1")) > 0
    total = per.agg(F.sum("all").alias("all"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.count(F.when(seen, 1)).alias("vocabulary")).first()
    docs = labels.agg(F.count(F.when(y == 0, 1)).alias("n0"), F.count(F.when(y == 1, 1)).alias("n1")).first()
    if not docs["n0"] or not docs["n1"]:
        raise ValueError("both classes need rows")
    size = [float((total[f"n{c}"] or 0) + smoothing * total["vocabulary"]) for c in (0, 1)]
    weight = F.log((F.col("n1") + smoothing) / F.lit(size[1])) - F.log((F.col("n0") + smoothing) / F.lit(size[0]))
    tokens = per.where(seen).select("token", weight.alias("weight"), (F.col("all") * HOT_SHARE >= F.lit(total["all"] or 0)).alias("hot"))
    prior = tokens.sparkSession.range(1).select(F.log(F.lit(float(docs["n1"])) / F.lit(float(docs["n0"]))).alias("p")).first()["p"]
    return NaiveBayes(tokens, prior)


def score_naive_bayes(model: NaiveBayes, docs: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """``docs`` (one row a ``key``) with ``score``, the log odds of class 1, and ``prediction``; tokens not seen in training say nothing.

    Hot tokens, at most ``HOT_SHARE``, are broadcast; the others are joined by
    token, where none has as much as 1 / ``HOT_SHARE`` of the rows."""
    hot, other = (model.tokens.where(F.col("hot") == h).select("token", "weight") for h in (True, False))
    near = counts.join(F.broadcast(hot.withColumnRenamed("weight", "hot_weight")), "token", "left")
    common = near.where(F.col("hot_weight").isNotNull()).select(key, "n", F.col("hot_weight").alias("weight"))
    rare = near.where(F.col("hot_weight").isNull()).select(key, "token", "n").join(other, "token").select(key, "n", "weight")
    sums = common.unionByName(rare).groupBy(key).agg(F.sum(F.col("n") * F.col("weight")).alias("_sum"))
    scored = docs.join(sums, key, "left").withColumn("score", F.lit(model.prior) + F.coalesce("_sum", F.lit(0.0))).drop("_sum")
    return scored.withColumn("prediction", (F.col("score") > 0).cast("int"))


@dataclass(frozen=True)
class Split:
    """A node's test: rows with ``feature`` >= ``edge`` (its ``bin``-th edge) go to node 2 * node + 1, others to 2 * node."""

    node: int
    feature: str
    bin: int
    edge: float
    n: int
    positive: int
    left_n: int
    left_positive: int


def bin_of(column: Column, edges: list[float]) -> Column:
    """How many of the ascending ``edges`` are at most the value; null counts as below all."""
    return reduce(lambda a, b: a + b, [F.when(column >= F.lit(e), 1).otherwise(0) for e in edges], F.lit(0))


def node_of(splits: list[Split], bins: bool, node: Column | None = None) -> Column:
    """The node that a row ends in, from its features (or their bins); the root is 1."""
    by_node = {s.node: s for s in splits}

    def below(n: int) -> Column:
        if n not in by_node:
            return F.lit(n)
        s = by_node[n]
        right = F.col(s.feature) > s.bin if bins else F.coalesce(F.col(s.feature) >= F.lit(s.edge), F.lit(False))
        return F.when(right, below(2 * n + 1)).otherwise(below(2 * n))

    return below(1)


def fit_tree(train: DataFrame, edges: dict[str, list[float]], label: str, depth: int = 3, min_rows: int = 1) -> list[Split]:
    """A decision tree for a 0/1 label, grown a level at a time by the Gini impurity.

    ``edges`` gives each numeric feature's split candidates. A level is one aggregate into a histogram of (node, feature, bin): at most
    2^level x features x bins rows leave it, partial sums before the shuffle, however many rows there are. The best split of a node maximises
    the two sides' sums of squared class counts over their sizes; ties go to the feature first by name, then to the lower edge.
    A node without two classes, or without a split that leaves ``min_rows`` on both sides and is better than none, is a leaf."""
    binned = train.where(F.col(label).isNotNull()).select(F.col(label).cast("long").alias("_y"), *(bin_of(F.col(f), e).alias(f) for f, e in edges.items()))
    binned = binned.checkpoint()
    splits: list[Split] = []
    for level in range(depth):
        here = binned.withColumn("_node", node_of(splits, bins=True))
        here = here.where((F.col("_node") >= 2**level) & (F.col("_node") < 2 ** (level + 1)))
        each = F.inline(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in sorted(edges))))
        cells = here.select("_node", "_y", each).groupBy("_node", "feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("p"))
        up = Window.partitionBy("_node", "feature").orderBy("bin")
        whole = Window.partitionBy("_node", "feature")
        cells = cells.select("_node", "feature", "bin", F.sum("n").over(up).alias("ln"), F.sum("p").over(up).alias("lp"),
                             F.sum("n").over(whole).alias("tn"), F.sum("p").over(whole).alias("tp"))
        cells = cells.where((F.col("ln") >= min_rows) & (F.col("tn") - F.col("ln") >= min_rows))
        cells = cells.select("*", _purity(F.col("ln"), F.col("lp"), F.col("tn"), F.col("tp")).alias("purity")).where(
            F.col("purity") > _square(F.col("tp"), F.col("tn")) + _square(F.col("tn") - F.col("tp"), F.col("tn")))
        first = Window.partitionBy("_node").orderBy(F.desc("purity"), "feature", "bin")
        best = cells.withColumn("_r", F.row_number().over(first)).where("_r = 1").collect()  # at most 2^level rows
        found = [Split(r["_node"], r["feature"], r["bin"], float(edges[r["feature"]][r["bin"]]), r["tn"], r["tp"], r["ln"], r["lp"]) for r in best]
        if not found:
            break
        splits += sorted(found, key=lambda s: s.node)
    return splits


def _square(n: Column, of: Column) -> Column:
    return n.cast("double") * n.cast("double") / of.cast("double")


def _purity(ln: Column, lp: Column, tn: Column, tp: Column) -> Column:
    rn, rp = tn - ln, tp - lp
    return _square(lp, ln) + _square(ln - lp, ln) + _square(rp, rn) + _square(rn - rp, rn)


def predict_tree(splits: list[Split], df: DataFrame, train_share: dict[int, tuple[int, int]]) -> DataFrame:
    """``df`` (with the features) with the ``node`` that each row ends in, the ``share`` of
    positives among the training rows there and the ``prediction`` (1 above a half)."""
    node = node_of(splits, bins=False)
    share = reduce(lambda c, item: c.when(F.col("node") == item[0], F.lit(item[1][1] / item[1][0])), train_share.items(), F.when(F.lit(False), F.lit(0.0)))
    return df.withColumn("node", node).withColumn("share", share).withColumn("prediction", (F.col("share") > 0.5).cast("int"))


def leaves(splits: list[Split], n: int, positive: int) -> dict[int, tuple[int, int]]:
    """Training rows and positives of every leaf, from the splits and the root's counts."""
    out = {1: (n, positive)}
    for s in splits:  # parents come before their children
        out.pop(s.node)
        out[2 * s.node] = s.left_n, s.left_positive
        out[2 * s.node + 1] = s.n - s.left_n, s.positive - s.left_positive
    return out


@dataclass(frozen=True)
class LinearMachine:
    """A linear classifier, its mean smoothed loss plus penalty, and the passes over the data that its fit took."""

    features: list[str]
    weights: list[float]
    intercept: float
    objective: float
    passes: int


def fit_svm(train: DataFrame, features: list[str], label: str, reg: float = 0.01, smoothing: float = 1e-3, max_steps: int = 20) -> LinearMachine:
    """Linear support vector machine for a 0/1 label: mean hinge loss plus ``reg`` / 2 times the
    squared weights of the features scaled to unit deviation; the intercept is free.

    The hinge is rounded off within ``smoothing`` of its corner, which moves the optimum's
    loss by at most half of that, and Newton's method is followed from a wide rounding down to it. A step is two
    aggregates: the gradient with the k x k curvature, and the losses of all step sizes tried at once; a few dozen
    numbers reach the driver. Some twenty passes replace the hundreds that plain subgradients need."""
    k = len(features)
    rows = train.where(F.col(label).isNotNull())
    spread_of = rows.agg(*(F.stddev_samp(f).alias(f) for f in features)).first()
    scale = [float(spread_of[f] or 0) or 1.0 for f in features]
    x = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) / F.lit(s) for f, s in zip(features, scale, strict=True)]
    y = F.when(F.col(label) > 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    data = rows.select(y.alias("y"), *(c.alias(f"x{i}") for i, c in enumerate(x)), F.lit(1.0).alias(f"x{k}")).checkpoint()
    penalty = np.array([reg] * k + [0.0])
    passes, w, loss = 1, np.zeros(k + 1), 1.0

    def short_of(v) -> Column:
        """How far a row's margin falls short of 1."""
        return F.lit(1.0) - F.col("y") * reduce(lambda a, b: a + b, (F.col(f"x{i}") * F.lit(float(c)) for i, c in enumerate(v)))

    def losses(vs: list[np.ndarray], width: float) -> np.ndarray:
        nonlocal passes
        passes += 1
        short = [F.col(f"s{i}") for i in range(len(vs))]
        each = [F.avg(F.when(s <= 0, 0.0).when(s < width, s * s / (2 * width)).otherwise(s - width / 2)) for s in short]
        got = data.select(*(short_of(v).alias(f"s{i}") for i, v in enumerate(vs))).agg(*(e.alias(f"l{i}") for i, e in enumerate(each))).first()
        return np.array(got, float) + [(penalty * v * v).sum() / 2 for v in vs]

    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    for width in [10.0 ** (1 - e) for e in range(20) if 10.0 ** (1 - e) > smoothing] + [smoothing]:
        loss = float(losses([w], width)[0])
        for _ in range(max_steps):
            passes += 1
            s, slope = F.col("s"), F.col("slope")
            steep = F.when(s <= 0, 0.0).when(s < width, s / width).otherwise(1.0)
            near = (s > 0) & (s < width)
            at = data.select("*", short_of(w).alias("s")).select("*", steep.alias("slope"))
            sums = [F.avg(-slope * F.col("y") * F.col(f"x{i}")) for i in range(k + 1)]
            sums += [F.avg(F.when(near, F.col(f"x{i}") * F.col(f"x{j}") / width).otherwise(0.0)) for i, j in pairs]
            got = np.array(at.agg(*(e.alias(f"a{i}") for i, e in enumerate(sums))).first(), float)
            gradient, curve = got[:k + 1] + penalty * w, np.diag(penalty + 1e-6)
            for (i, j), v in zip(pairs, got[k + 1:], strict=True):
                curve[i, j] += v
                curve[j, i] += v if i != j else 0.0
            step = -np.linalg.solve(curve, gradient)
            if -gradient @ step < (1e-6 if width == smoothing else 1e-2) * max(loss, 1e-12):
                break
            tried = [w + step * 0.5**e for e in range(12)]
            found = losses(tried, width)
            if found.min() >= loss - 1e-9 * loss:
                break
            w, loss = tried[int(found.argmin())], float(found.min())
    weights = [float(c) / s for c, s in zip(w, scale, strict=False)]
    return LinearMachine(list(features), weights, float(w[k]), float(loss), passes)


def predict_svm(model: LinearMachine, df: DataFrame) -> DataFrame:
    """``df`` with ``margin``, above 0 for class 1, and ``prediction``; null features count as 0."""
    margin = F.lit(model.intercept)
    for f, w in zip(model.features, model.weights, strict=True):
        margin = margin + F.coalesce(F.col(f).cast("double"), F.lit(0.0)) * F.lit(w)
    return df.withColumn("margin", margin).withColumn("prediction", (F.col("margin") > 0).cast("int"))
