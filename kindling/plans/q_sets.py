"""Set operations, sampling, splits and key joins (SET1-SET8, JOIN4, JOIN9, JOIN10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindling.operators.lookup import cogroup_rows, cogroup_sizes, outer_join, point_lookup
from kindling.operators.setops import distinct, intersect_distinct, subtract_bag, union_all
from kindling.operators.splits import all_but_n, hash_split, kfold, sample_by_hash
from kindling.plans.common import T
from kindling.plans.fixtures import timed_ratings

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _cust_nations(spark, sf):
    return T(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"),
                                           F.col("c_mktsegment").alias("segment"))


def _supp_nations(spark, sf):
    # Suppliers do not have a market segment; tag them by account sign instead.
    s = T(spark, sf, "supplier")
    return s.select(F.col("s_nationkey").alias("nationkey"),
                    F.when(F.col("s_acctbal") < 5000, "BUILDING").otherwise("MACHINERY").alias("segment"))


_CN = "SELECT c_nationkey AS nationkey, c_mktsegment AS segment FROM customer"
_SN = ("SELECT s_nationkey AS nationkey, CASE WHEN s_acctbal < 5000 THEN 'BUILDING' ELSE 'MACHINERY' END AS segment "
       "FROM supplier")


@register("set_union", f"{_CN} UNION ALL {_SN}")
def set_union(spark, sf):
    return union_all(_cust_nations(spark, sf), _supp_nations(spark, sf))


@register("set_intersect", f"{_CN} INTERSECT {_SN}")
def set_intersect(spark, sf):
    return intersect_distinct(_cust_nations(spark, sf), _supp_nations(spark, sf))


@register("set_subtract_bag", f"""
SELECT c.* FROM ({_CN}) c
WHERE NOT EXISTS (SELECT 1 FROM ({_SN}) s
                  WHERE s.nationkey IS NOT DISTINCT FROM c.nationkey AND s.segment IS NOT DISTINCT FROM c.segment)
""")
def set_subtract_bag(spark, sf):
    return subtract_bag(_cust_nations(spark, sf), _supp_nations(spark, sf))


@register("set_distinct", f"SELECT DISTINCT nationkey, segment FROM ({_CN})")
def set_distinct(spark, sf):
    return distinct(_cust_nations(spark, sf))


_HASH = "CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8)) AS BIGINT) % 100"


@register("sample_by_hash", f"SELECT * FROM customer WHERE {_HASH.format(k='c_custkey')} < 10")
def q_sample_by_hash(spark, sf):
    return sample_by_hash(T(spark, sf, "customer"), "c_custkey", 10)


@register("hash_split_train", f"SELECT o_orderkey, o_custkey FROM orders WHERE {_HASH.format(k='o_orderkey')} < 50")
def hash_split_train(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return hash_split(o, "o_orderkey", 50)[0]


_R = ("r AS (SELECT o.o_custkey AS \"user\", l.l_suppkey AS item, avg(l.l_quantity) AS rating, "
      "min(o.o_orderdate) AS ts FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)")

# Fixed parameters of the holdout: ratings 1-10 of every user, without a limit of test rows.
HOLDOUT_START, HOLDOUT_STOP = 1, 10


@register("split_all_but_n", f"""
WITH {_R},
n AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY ts, item) AS rn FROM r)
SELECT "user", item, CASE WHEN rn BETWEEN {HOLDOUT_START} AND {HOLDOUT_STOP} THEN 'test' ELSE 'base' END AS split FROM n
""")
def split_all_but_n(spark, sf):
    r = timed_ratings(spark, sf)
    out = all_but_n(r, "user", ["ts", "user", "item"], HOLDOUT_START, HOLDOUT_STOP, 0)
    return out.select("user", "item", "split")


@register("split_kfold", f"""
WITH {_R}
SELECT "user", item, CAST(ntile(5) OVER (ORDER BY ts, "user", item) AS INTEGER) AS fold FROM r
""")
def split_kfold(spark, sf):
    r = timed_ratings(spark, sf)
    return kfold(r, ["ts", "user", "item"], 5).select("user", "item", "fold")


@register("outer_joins", """
SELECT c.c_custkey, c.c_name, o.o_orderkey FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
""")
def outer_joins(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_name")
    o = T(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return outer_join(c, o, "c_custkey", "left")


@register("right_outer_join", """
SELECT o.o_orderkey, n.n_nationkey, n.n_name
FROM (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1) n
RIGHT JOIN (SELECT o_orderkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey) o
  ON o.c_nationkey = n.n_nationkey
""")
def right_outer_join(spark, sf):
    n = T(spark, sf, "nation").filter(F.col("n_regionkey") == 1).select(
        F.col("n_nationkey").alias("k"), "n_nationkey", "n_name")
    oc = T(spark, sf, "orders").join(T(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("c_nationkey").alias("k"))
    return outer_join(n, oc, "k", "right").select("o_orderkey", "n_nationkey", "n_name")


@register("cogroup_sizes", """
SELECT coalesce(c.k, o.k) AS c_custkey, CAST(coalesce(c.n, 0) AS BIGINT) AS left_rows,
       CAST(coalesce(o.n, 0) AS BIGINT) AS right_rows
FROM (SELECT c_custkey AS k, count(*) AS n FROM customer GROUP BY 1) c
FULL JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) o ON c.k = o.k
""")
def q_cogroup_sizes(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey")
    o = T(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return cogroup_sizes(c, o, "c_custkey")


@register("cogroup_rows", """
SELECT c_custkey, 'left' AS side, c_acctbal AS balance, CAST(NULL AS BIGINT) AS o_orderkey FROM customer
UNION ALL SELECT o_custkey, 'right', NULL, o_orderkey FROM orders
""")
def q_cogroup_rows(spark, sf):
    """JOIN10: each customer's row and order keys, run by run."""
    c = T(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"))
    o = T(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return cogroup_rows(c, o, "c_custkey", ["balance"], ["o_orderkey"]).select(
        "c_custkey", "side", "left.balance", "right.o_orderkey")


@register("lookup_key", """
WITH k AS (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10)
SELECT o.o_custkey AS c_custkey, o.o_orderkey, o.o_totalprice FROM orders o JOIN k ON o.o_custkey = k.c_custkey
""")
def lookup_key(spark, sf):
    keys = T(spark, sf, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(10).select("c_custkey")
    o = T(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return point_lookup(o, keys, "c_custkey")
