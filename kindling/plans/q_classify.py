"""Classifiers of documents by `labels.quality` (ML1) and linear regression on several features (REG1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindling.functions.rounding import round_half_up
from kindling.operators.classification import (LOWER, UPPER, fit_naive_bayes, fit_svm, fit_tree, leaves, predict_svm, predict_tree, score_naive_bayes,
                                                token_counts)
from kindling.operators.regression import sgd_gram, zscore
from kindling.operators.sizing import small_frame, spread
from kindling.operators.splits import hash_bucket
from kindling.plans.common import R4, T
from kindling.plans.q_ml import _HASH, SGD_ITER, SGD_REG, SGD_TOL

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


TRAIN_PERCENT = 70


@register("naive_bayes_documents", f"""
WITH words AS (SELECT doc_id, unnest(string_split_regex(translate(text, '{UPPER}', '{LOWER}'), '[ \\t\\n\\x0b\\f\\r]+')) AS token FROM documents),
c AS (SELECT doc_id, token, count(*) AS n FROM words WHERE token <> '' GROUP BY ALL),
l AS (SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL AND {_HASH} < {TRAIN_PERCENT} AND doc_id IN (SELECT doc_id FROM documents)),
t AS (SELECT token, sum(n) FILTER (quality = 0) AS n0, sum(n) FILTER (quality = 1) AS n1 FROM c JOIN l USING (doc_id) GROUP BY token),
s AS (SELECT sum(n0) + count(*) AS s0, sum(n1) + count(*) AS s1 FROM t),
w AS (SELECT token, ln((coalesce(n1, 0) + 1) / s1) - ln((coalesce(n0, 0) + 1) / s0) AS weight FROM t, s),
p AS (SELECT ln(count(*) FILTER (quality = 1)::DOUBLE / count(*) FILTER (quality = 0)::DOUBLE) AS prior FROM l),
d AS (SELECT doc_id, sum(n * weight) AS total FROM c JOIN w USING (token) GROUP BY doc_id)
SELECT doc_id, {R4('prior + coalesce(total, 0)')} AS score, (prior + coalesce(total, 0) > 0)::INT AS prediction
FROM documents LEFT JOIN d USING (doc_id) CROSS JOIN p
""")
def naive_bayes_documents(spark, sf):
    """ML1: multinomial naive Bayes over all words, learned from a 70 % hash split of the labelled documents; every document is scored."""
    docs = T(spark, sf, "documents").select("doc_id", "text")
    labels = T(spark, sf, "labels").where(F.col("quality").isNotNull() & (hash_bucket("doc_id") < TRAIN_PERCENT)).select("doc_id", "quality")
    labels = labels.join(docs.select("doc_id"), "doc_id", "left_semi")
    counts = token_counts(spread(docs), "doc_id", "text").checkpoint()
    scored = score_naive_bayes(fit_naive_bayes(counts, labels, "doc_id", "quality"), docs.select("doc_id"), counts, "doc_id")
    return scored.select("doc_id", round_half_up("score").alias("score"), "prediction")


#: Numbers of characters, spaces, line ends and symbols of a text, and their split candidates: powers of two.
_COUNTED = {"n_spaces": " ", "n_lines": "\n", "n_symbols": "#*$%&|<>"}
EDGES = {"n_chars": [float(2**k) for k in range(16)], **{f: [float(2**k) for k in range(12)] for f in _COUNTED}}
DEPTH, MIN_ROWS = 3, 5


def _text_features(spark, sf):
    d = spread(T(spark, sf, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    counted = [(F.length(text) - F.length(F.translate(text, chars, ""))).cast("double").alias(f) for f, chars in _COUNTED.items()]
    return d.select("doc_id", F.length(text).cast("double").alias("n_chars"), *counted)


_FEATURES_SQL = "f AS (SELECT doc_id, length(coalesce(text, ''))::DOUBLE AS n_chars, " + ", ".join(
    f"(length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{c}', '')))::DOUBLE AS {f}" for f, c in _COUNTED.items()) + " FROM documents)"


def _tree_sql() -> str:
    """The tree's levels as CTEs: cells, best splits, and the rows' nodes after them."""
    square = "({0})::DOUBLE * ({0})::DOUBLE / ({1})::DOUBLE".format
    better = " + ".join(square(a, b) for a, b in (("lp", "ln"), ("ln - lp", "ln"), ("tp - lp", "tn - ln"), ("(tn - ln) - (tp - lp)", "tn - ln")))
    bins = ", ".join(f"({' + '.join(f'({f} >= {e})::INT' for e in edges)}) AS {f}" for f, edges in EDGES.items())
    ctes = [_FEATURES_SQL, f"b0 AS (SELECT quality::BIGINT AS y, 1 AS node, {bins} FROM f JOIN labels USING (doc_id) WHERE quality IS NOT NULL)"]
    for k in range(DEPTH):
        each = " UNION ALL ".join(f"SELECT node, y, '{f}' AS feature, {f} AS bin FROM b{k} WHERE node >= {2**k}" for f in sorted(EDGES))
        ctes.append(f"c{k} AS (SELECT node, feature, bin, count(*) AS n, sum(y) AS p FROM ({each}) GROUP BY ALL)")
        ctes.append(f"""u{k} AS (SELECT node, feature, bin, sum(n) OVER w AS ln, sum(p) OVER w AS lp, sum(n) OVER a AS tn, sum(p) OVER a AS tp FROM c{k}
            WINDOW w AS (PARTITION BY node, feature ORDER BY bin), a AS (PARTITION BY node, feature))""")
        ctes.append(f"""s{k} AS (SELECT * FROM (SELECT *, {better} AS purity FROM u{k} WHERE ln >= {MIN_ROWS} AND tn - ln >= {MIN_ROWS})
            WHERE purity > {square('tp', 'tn')} + {square('tn - tp', 'tn')}
            QUALIFY row_number() OVER (PARTITION BY node ORDER BY purity DESC, feature, bin) = 1)""")
        right = "CASE s.feature " + " ".join(f"WHEN '{f}' THEN b.{f}" for f in EDGES) + " END > s.bin"
        columns = ", ".join(f"b.{f}" for f in EDGES)
        ctes.append(f"b{k + 1} AS (SELECT y, CASE WHEN s.node IS NULL THEN b.node ELSE 2 * b.node + ({right})::INT END AS node, {columns} FROM b{k} b LEFT JOIN s{k} s ON s.node = b.node)")
    ctes.append("splits AS (" + " UNION ALL ".join(f"SELECT * FROM s{k}" for k in range(DEPTH)) + ")")
    return "WITH " + ",\n".join(ctes)


def _tree(spark, sf):
    features = _text_features(spark, sf)
    train = features.join(T(spark, sf, "labels").where("quality IS NOT NULL").select("doc_id", "quality"), "doc_id")
    return features, train, fit_tree(train, EDGES, "quality", DEPTH, MIN_ROWS)


@register("decision_tree_splits", _tree_sql() + """
SELECT node::INT AS node, feature, pow(2, bin)::DOUBLE AS edge, tn::BIGINT AS n, tp::BIGINT AS positive, ln::BIGINT AS left_n, lp::BIGINT AS left_positive FROM splits
""")
def decision_tree_splits(spark, sf):
    """ML1: the splits of a decision tree of depth 3, learned from all labelled documents, one histogram aggregate a level."""
    _, _, splits = _tree(spark, sf)
    rows = [(s.node, s.feature, s.edge, s.n, s.positive, s.left_n, s.left_positive) for s in splits]
    return small_frame(spark, rows, "node INT, feature STRING, edge DOUBLE, n BIGINT, positive BIGINT, left_n BIGINT, left_positive BIGINT")


def _placed_sql() -> str:
    """Every document's node, walked down from the root by its features."""
    ctes = ["g0 AS (SELECT f.*, 1 AS node FROM f)"]
    for k in range(DEPTH):
        right = "CASE s.feature " + " ".join(f"WHEN '{f}' THEN g.{f}" for f in EDGES) + " END >= pow(2, s.bin)"
        columns = ", ".join(f"g.{f}" for f in EDGES)
        ctes.append(f"g{k + 1} AS (SELECT g.doc_id, {columns}, CASE WHEN s.node IS NULL THEN g.node ELSE 2 * g.node + ({right})::INT END AS node FROM g{k} g LEFT JOIN s{k} s ON s.node = g.node)")
    return ",\n" + ",\n".join(ctes)


@register("decision_tree_documents", _tree_sql() + _placed_sql() + f""",
leaf AS (SELECT node, sum(y)::DOUBLE / count(*)::DOUBLE AS share FROM b{DEPTH} GROUP BY node)
SELECT doc_id, g.node::INT AS node, {R4('share')} AS share, (share > 0.5)::INT AS prediction FROM g{DEPTH} g LEFT JOIN leaf USING (node)
""")
def decision_tree_documents(spark, sf):
    """ML1: every document's leaf in that tree, the leaf's share of good documents, and the prediction."""
    features, train, splits = _tree(spark, sf)
    root = train.agg(F.count(F.lit(1)).alias("n"), F.sum("quality").cast("long").alias("p")).first()
    scored = predict_tree(splits, features, leaves(splits, root["n"], root["p"]))
    return scored.select("doc_id", F.col("node").cast("int").alias("node"), round_half_up("share").alias("share"), "prediction")


@register("svm_documents")
def svm_documents(spark, sf):
    """ML1: a linear support vector machine on the counts' logarithms, learned from a 70 % hash split of the labelled documents;
    every other document is predicted. Rows-only check: the tests hold the fitted optimum against a solver of their own."""
    features = _text_features(spark, sf)
    names = list(EDGES)
    logs = features.select("doc_id", *(F.log1p(f).alias(f) for f in names))
    data = logs.join(T(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    training = F.col("quality").isNotNull() & (hash_bucket("doc_id") < TRAIN_PERCENT)
    model = fit_svm(data.where(training), names, "quality")
    scored = predict_svm(model, data.where(~training))
    return scored.select("doc_id", F.col("quality").cast("int").alias("quality"), "prediction")


_X = ["n_spaces", "n_lines", "n_symbols"]


def _gram_sql() -> str:
    z = [*_X, "n_chars"]
    moments = ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in z)
    scaled = ", ".join(f"(f.{f} - m_{f}) / CASE WHEN s_{f} = 0 THEN 1 ELSE s_{f} END AS {f}" for f in z)
    gram = ", ".join([f"avg({a} * {b}) AS g{i}{j}" for i, a in enumerate(_X) for j, b in enumerate(_X)] + [f"avg({a} * n_chars) AS h{i}" for i, a in enumerate(_X)])
    step = "1.0::DOUBLE / sqrt(t + 1)"
    new = [f"w{i} * (1.0 - {step} * {SGD_REG}) - {step} * (" + " + ".join(f"w{j} * g{i}{j}" for j in range(3)) + f" - h{i})" for i in range(3)]
    norm = lambda v: "sqrt(" + " + ".join(f"({x}) * ({x})" for x in v) + ")"
    change = norm([f"({n}) - w{i}" for i, n in enumerate(new)])
    return f"""WITH RECURSIVE {_FEATURES_SQL},
m AS (SELECT {moments} FROM f), z AS (SELECT {scaled} FROM f, m), g AS (SELECT {gram} FROM z),
it(t, w0, w1, w2, change) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, NULL::DOUBLE
  UNION ALL SELECT t + 1, {', '.join(new)}, {change} FROM it, g
  WHERE t < {SGD_ITER} AND NOT (t >= 2 AND change < {SGD_TOL} * greatest({norm(['w0', 'w1', 'w2'])}, 1.0)))
SELECT unnest(['{"', '".join(_X)}']) AS feature, unnest([{', '.join(R4(f'w{i}') for i in range(3))}]) AS weight, t::INT AS steps
FROM (SELECT * FROM it ORDER BY t DESC LIMIT 1)"""


@register("regression_sgd_features", _gram_sql())
def regression_sgd_features(spark, sf):
    """REG1 with several features: a document's length from its spaces, line ends and symbols, all scaled, by the recursion on the Gram matrix."""
    z = zscore(_text_features(spark, sf), [*_X, "n_chars"])
    weights, steps = sgd_gram(z, [f"{f}_z" for f in _X], "n_chars_z", SGD_ITER, 1.0, SGD_REG, SGD_TOL)
    rows = [(f, w, steps) for f, w in zip(_X, weights, strict=True)]
    return small_frame(spark, rows, "feature STRING, weight DOUBLE, steps INT").select("feature", round_half_up("weight").alias("weight"), "steps")
