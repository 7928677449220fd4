"""Regression, recommendation and classification queries (REG1-REG3, REC1-REC3, ML1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindling.functions.rounding import round_half_up
from kindling.operators.recommend import fit_als, recommend, user_ratings
from kindling.operators.regression import fit_elastic_net, predict, sgd_least_squares, text_classifier, zscore
from kindling.operators.sizing import small_frame
from kindling.operators.splits import hash_bucket
from kindling.plans.common import R4, T
from kindling.plans.fixtures import ratings

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Fixed parameters of the reference's regressions and of the example user.
REG, ALPHA = 0.3, 0.8
SGD_REG, SGD_TOL, SGD_ITER = 0.01, 0.001, 100
USER_ID = 1


def _doc_xy(spark, sf):
    """x = spaces in the text, y = its length, both z-scored over all documents."""
    d = T(spark, sf, "documents").select(
        "doc_id",
        (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).cast("double").alias("sp"),
        F.col("n_chars").cast("double").alias("len"),
    )
    z = zscore(d, ["sp", "len"])
    return z.select("doc_id", F.col("sp_z").alias("x"), F.col("len_z").alias("y"))


_XY = """d AS (SELECT doc_id, CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS sp,
                CAST(n_chars AS DOUBLE) AS len FROM documents),
st AS (SELECT avg(sp) AS mx, stddev_pop(sp) AS sx, avg(len) AS my, stddev_pop(len) AS sy FROM d),
z AS (SELECT doc_id, (sp - mx) / sx AS x, (len - my) / sy AS y FROM d JOIN st ON true)"""
_HASH = "CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100"
_FIT = f"""tr AS (SELECT * FROM z WHERE {_HASH} < 50),
s AS (SELECT corr(x, y) AS r, stddev_pop(x) AS sx, stddev_pop(y) AS sy, avg(x) AS mx, avg(y) AS my FROM tr),
b AS (SELECT sign(r) * greatest(abs(r) - {ALPHA} * ({REG} / sy), 0) / (1 + (1 - {ALPHA}) * ({REG} / sy)) * sy / sx AS w,
             mx, my FROM s),
m AS (SELECT w, my - w * mx AS b FROM b)"""


def _train_test(spark, sf):
    xy = _doc_xy(spark, sf).checkpoint()
    b = hash_bucket("doc_id")
    return xy.filter(b < 50), xy.filter(b >= 50)


@register("regression_elastic_net", f"""
WITH {_XY}, {_FIT}
SELECT {R4('w')} AS weight, {R4('b')} AS intercept FROM m
""")
def regression_elastic_net(spark, sf):
    train, _ = _train_test(spark, sf)
    model = fit_elastic_net(train, ["x"], "y", REG, ALPHA)
    w, b = float(model.coefficients[0]), float(model.intercept)
    return small_frame(spark, [(w, b)], "weight DOUBLE, intercept DOUBLE").select(
        round_half_up("weight").alias("weight"), round_half_up("intercept").alias("intercept"))


@register("regression_predictions", f"""
WITH {_XY}, {_FIT}
SELECT z.doc_id, {R4('z.y')} AS label, {R4('m.w * z.x + m.b')} AS prediction
FROM z JOIN m ON true WHERE {_HASH.replace('doc_id', 'z.doc_id')} >= 50
""")
def regression_predictions(spark, sf):
    train, test = _train_test(spark, sf)
    model = fit_elastic_net(train, ["x"], "y", REG, ALPHA)
    scored = predict(model, test, ["x"])
    return scored.select("doc_id", round_half_up("y").alias("label"), round_half_up("prediction").alias("prediction"))


@register("regression_sgd", f"""
WITH RECURSIVE {_XY},
s2 AS (SELECT avg(x * x) AS exx, avg(x * y) AS exy FROM z),
it(t, w, dw) AS (
  SELECT 0, CAST(0.0 AS DOUBLE), CAST(NULL AS DOUBLE)
  UNION ALL
  SELECT it.t + 1,
         it.w * (1.0 - (1.0 / sqrt(it.t + 1)) * {SGD_REG}) - (1.0 / sqrt(it.t + 1)) * (it.w * s2.exx - s2.exy),
         (it.w * (1.0 - (1.0 / sqrt(it.t + 1)) * {SGD_REG}) - (1.0 / sqrt(it.t + 1)) * (it.w * s2.exx - s2.exy)) - it.w
  FROM it JOIN s2 ON true
  WHERE it.t < {SGD_ITER} AND NOT (it.t >= 2 AND abs(it.dw) < {SGD_TOL} * greatest(abs(it.w), 1.0)))
SELECT {R4('w')} AS weight, CAST(t AS INTEGER) AS steps FROM it ORDER BY t DESC LIMIT 1
""")
def regression_sgd(spark, sf):
    xy = _doc_xy(spark, sf)
    w, steps = sgd_least_squares(xy, "x", "y", SGD_ITER, 1.0, SGD_REG, SGD_TOL)
    return small_frame(spark, [(w, steps)], "weight DOUBLE, steps INT").select(
        round_half_up("weight").alias("weight"), "steps")


@register("als_recommend")
def als_recommend(spark, sf):
    """REC1/REC2: ALS fitted on all of R (customer x part), then the top 10 items for
    the example user, as the reference does. Rows-only check: 10 distinct items in
    descending score (see tests)."""
    r = ratings(spark, sf, item="l_partkey").checkpoint()
    model = fit_als(r)
    me = r.filter(F.col("user") == F.lit(USER_ID)).select("user").distinct()
    recs = recommend(model, me, 10)
    return recs.select(F.col("user").cast("bigint").alias("user"), F.col("item").cast("bigint").alias("item"),
                       round_half_up("score").alias("score"), "rank")


@register("als_recommend_known", f"""
SELECT {USER_ID}::BIGINT AS "user", unnest(range(1, 11))::INT AS rank, true AS known_item
""")
def als_recommend_known(spark, sf):
    """REC1/REC2 on ids past 2^31, which need the dictionary: ten ranks for the example user, all of items that somebody rated."""
    far = 2**33
    r = ratings(spark, sf, item="l_partkey").select((F.col("user") + far).alias("user"), (F.col("item") * far).alias("item"), "rating").checkpoint()
    recs = recommend(fit_als(r, max_iter=5), r.where(F.col("user") == USER_ID + far).select("user").distinct(), 10)
    known = r.select("item", F.lit(True).alias("known")).distinct()
    return recs.join(known, "item", "left").select((F.col("user") - far).alias("user"), "rank", F.coalesce("known", F.lit(False)).alias("known_item"))


@register("user_ratings", f"""
WITH r AS (SELECT o.o_custkey AS u, l.l_partkey AS item, avg(l.l_quantity) AS rating
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)
SELECT r.u AS "user", r.item, {R4('r.rating')} AS rating, p.p_name AS name
FROM r LEFT JOIN part p ON p.p_partkey = r.item WHERE r.u = {USER_ID}
""")
def q_user_ratings(spark, sf):
    r = ratings(spark, sf, item="l_partkey")
    out = user_ratings(r, USER_ID, T(spark, sf, "part"), "p_partkey", "p_name")
    return out.select("user", "item", round_half_up("rating").alias("rating"), F.col("p_name").alias("name"))


@register("classify_documents")
def classify_documents(spark, sf):
    """ML1: hashed TF-IDF + logistic regression for `labels.quality`; trained on a
    70% hash split of labelled documents, all other documents are scored
    (``quality`` is null where there is no label). Rows-only check."""
    d = T(spark, sf, "documents").select("doc_id", "text")
    lab = T(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    data = d.join(lab, "doc_id", "left")
    training = (hash_bucket("doc_id") < 70) & F.col("label").isNotNull()
    model = text_classifier(data.filter(training), "text", "label")
    scored = model.transform(data.filter(~training))
    return scored.select("doc_id", F.col("label").cast("int").alias("quality"),
                         F.col("prediction").cast("int").alias("prediction"))
