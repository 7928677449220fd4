"""Item-item similarity on the ratings analogue R (REC4-REC6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindling.functions.rounding import round_half_up
from kindling.operators.similarity import hash_partition, item_similarity, similar_items, top_pairs
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


def _r_cte(item_col: str) -> str:
    return (
        "r AS (SELECT o.o_custkey AS u, l.{c} AS item, avg(l.l_quantity) AS rating "
        "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)"
    ).format(c=item_col)


_PAIRS = """
p AS (SELECT a.item AS item_i, b.item AS item_j, sum(a.rating * a.rating) AS sxx,
             sum(b.rating * b.rating) AS syy, sum(a.rating * b.rating) AS sxy, count(*) AS n
      FROM r a JOIN r b ON a.u = b.u AND a.item < b.item GROUP BY 1, 2)
"""
_SCORE = "CASE WHEN sqrt(sxx) * sqrt(syy) <> 0 THEN sxy / (sqrt(sxx) * sqrt(syy)) ELSE 0.0 END"

# Parameters of the one-item query (the reference's 0.97 / 50 select nothing here).
TARGET_SUPPLIER = 1
MIN_SCORE = 0.80
MIN_N = 20


@register("item_similarity", f"""
WITH {_r_cte('l_suppkey')}, {_PAIRS}
SELECT item_i, item_j, {R4(_SCORE)} AS score, n FROM p
""")
def q_item_similarity(spark, sf):
    # CH1: R is read once, and kept packed (see operators/baskets.py).
    sim = item_similarity(ratings(spark, sf))
    return sim.select("item_i", "item_j", round_half_up("score").alias("score"), "n")


@register("similar_items_topk", f"""
WITH {_r_cte('l_suppkey')}, {_PAIRS},
s AS (SELECT CASE WHEN item_i = {TARGET_SUPPLIER} THEN item_j ELSE item_i END AS other,
             {_SCORE} AS score, n FROM p
      WHERE (item_i = {TARGET_SUPPLIER} OR item_j = {TARGET_SUPPLIER})),
top AS (SELECT * FROM s WHERE score > {MIN_SCORE} AND n > {MIN_N}
        ORDER BY score DESC, n DESC, other LIMIT 10)
SELECT top.other, {R4('top.score')} AS score, top.n, sp.s_name AS name
FROM top LEFT JOIN supplier sp ON sp.s_suppkey = top.other
""")
def q_similar_items_topk(spark, sf):
    top = similar_items(
        ratings(spark, sf).checkpoint(), TARGET_SUPPLIER, MIN_SCORE, MIN_N, 10,
        names=T(spark, sf, "supplier"), name_key="s_suppkey", name_col="s_name",
    )
    return top.select("other", round_half_up("score").alias("score"), "n", F.col("s_name").alias("name"))


@register("item_similarity_partitioned", f"""
WITH {_r_cte('l_partkey')}, {_PAIRS}
SELECT item_i, item_j, {R4(_SCORE)} AS score, n FROM p WHERE n >= 2
""")
def q_item_similarity_partitioned(spark, sf):
    return item_similarity(ratings(spark, sf, item="l_partkey"), min_n=2).select(
        "item_i", "item_j", round_half_up("score").alias("score"), "n")


# The cuts of the large-scale program, at counts that these tables reach.
PAIR_SCORE, PAIR_N, PAIR_TOP = 0.97, 3, 50


@register("similar_pairs_top50", f"""
WITH {_r_cte('l_partkey')}, {_PAIRS},
s AS (SELECT item_i, item_j, {R4('score')} AS score, n FROM (SELECT *, {_SCORE} AS score FROM p WHERE n > {PAIR_N}) WHERE score > {PAIR_SCORE}),
top AS (SELECT * FROM s ORDER BY score DESC, n DESC, item_i, item_j LIMIT {PAIR_TOP})
SELECT top.*, i.p_name AS name_i, j.p_name AS name_j FROM top LEFT JOIN part i ON i.p_partkey = item_i LEFT JOIN part j ON j.p_partkey = item_j
""")
def similar_pairs_top50(spark, sf):
    """REC6: the 50 most similar pairs of parts above both cuts, with names; ratings that no such pair can use are dropped before the self-join."""
    return top_pairs(ratings(spark, sf, item="l_partkey").checkpoint(), PAIR_SCORE, PAIR_N, PAIR_TOP, T(spark, sf, "part"), "p_partkey", "p_name")


@register("rating_deviation", f"""
WITH {_r_cte('l_suppkey')}, m AS (SELECT u, avg(rating) AS mean, count(*) AS n FROM r GROUP BY u)
SELECT u AS "user", item, {R4('rating - mean')} AS deviation, n FROM r JOIN m USING (u)
""")
def rating_deviation(spark, sf):
    """PT1: R is partitioned by user once; the users' means and the join back to the ratings both use that partitioning."""
    r = hash_partition(ratings(spark, sf), int(spark.conf.get("spark.sql.shuffle.partitions")), "user")
    means = r.groupBy("user").agg(F.avg("rating").alias("mean"), F.count(F.lit(1)).alias("n"))
    return r.join(means, "user").select("user", "item", round_half_up(F.col("rating") - F.col("mean")).alias("deviation"), "n")
