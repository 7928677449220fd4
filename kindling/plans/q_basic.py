"""Keyed aggregates, sorts, projections, filters and SQL views on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindling.functions.rounding import hundredths_text, round_half_up, sql_hundredths_text
from kindling.functions.scalar import tenths_celsius_to_fahrenheit
from kindling.operators import aggregates as agg
from kindling.operators.combine import reduce_by_key
from kindling.operators.lookup import lookup_names
from kindling.operators.topk import sort_by, top_k
from kindling.plans.common import R4, T

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- popularity (AGG2 + SRT3 + JOIN2): the flagship ---------------------------

@register("popularity_named_topk", """
WITH c AS (
  SELECT l_partkey AS partkey, count(*) AS count FROM lineitem
  GROUP BY l_partkey ORDER BY count DESC, partkey LIMIT 10)
SELECT c.partkey, p.p_name AS name, c.count
FROM c LEFT JOIN part p ON p.p_partkey = c.partkey
""")
def popularity_named_topk(spark, sf):
    counts = agg.count_by_key(T(spark, sf, "lineitem").select(F.col("l_partkey").alias("partkey")), "partkey")
    top = top_k(counts, "count", 10, ascending=False, tiebreak=["partkey"])
    named = lookup_names(top, T(spark, sf, "part"), "partkey", "p_partkey", "p_name", df_max_rows=10)
    return named.select("partkey", F.col("p_name").alias("name"), "count")


@register("popularity_asc", """
SELECT l_partkey AS partkey, count(*) AS count FROM lineitem GROUP BY l_partkey
""")
def popularity_asc(spark, sf):
    counts = agg.count_by_key(T(spark, sf, "lineitem").select(F.col("l_partkey").alias("partkey")), "partkey")
    return sort_by(counts, "count", True, ["partkey"])


@register("popularity_dataset_topk", """
SELECT l_suppkey AS suppkey, count(*) AS count FROM lineitem
GROUP BY l_suppkey ORDER BY count DESC, suppkey LIMIT 10
""")
def popularity_dataset_topk(spark, sf):
    li = T(spark, sf, "lineitem").select(F.col("l_suppkey").alias("suppkey"))
    return li.groupBy("suppkey").count().orderBy(F.desc("count"), "suppkey").limit(10)


@register("value_histogram", """
SELECT l_linenumber, count(*) AS count FROM lineitem GROUP BY l_linenumber
""")
def value_histogram(spark, sf):
    h = agg.count_by_value(T(spark, sf, "lineitem"), "l_linenumber")
    return sort_by(h, "l_linenumber")


@register("avg_div_by_key", """
SELECT l_linenumber,
       CAST(sum(CAST(l_quantity AS BIGINT)) // count(l_quantity) AS BIGINT) AS avg_quantity
FROM lineitem GROUP BY l_linenumber
""")
def avg_div_by_key(spark, sf):
    return agg.avg_div_by_key(T(spark, sf, "lineitem"), "l_linenumber", "l_quantity", "avg_quantity")


@register("avg_exact_by_key", f"""
SELECT l_linenumber, {R4('avg(l_quantity)')} AS avg_quantity FROM lineitem GROUP BY l_linenumber
""")
def avg_exact_by_key(spark, sf):
    a = agg.avg_by_key(T(spark, sf, "lineitem"), "l_linenumber", "l_quantity", "avg_quantity")
    return a.select("l_linenumber", round_half_up("avg_quantity").alias("avg_quantity"))


def _scaled(spark, sf, event_type, fn, out):
    ev = T(spark, sf, "events").filter(F.col("event_type") == event_type)
    per_user = fn(ev, "user_id", tenths_celsius_to_fahrenheit("value"), out)
    return per_user.select(
        "user_id",
        round_half_up(out).alias(out),
        hundredths_text(out, " F").alias(f"{out}_text"),
    )


_SCALED_SQL = """
SELECT user_id, {r} AS {out}, {txt} AS {out}_text
FROM (SELECT user_id, {fn}(value * 0.1 * (9.0 / 5.0) + 32.0) AS v
      FROM events WHERE event_type = '{et}' GROUP BY user_id)
"""


@register("min_scaled_by_key", _SCALED_SQL.format(
    r=R4("v"), txt=sql_hundredths_text("v", " F"), out="min_temp", fn="min", et="view"))
def min_scaled_by_key(spark, sf):
    return _scaled(spark, sf, "view", agg.min_by_key, "min_temp")


@register("max_scaled_by_key", _SCALED_SQL.format(
    r=R4("v"), txt=sql_hundredths_text("v", " F"), out="max_temp", fn="max", et="purchase"))
def max_scaled_by_key(spark, sf):
    return _scaled(spark, sf, "purchase", agg.max_by_key, "max_temp")


_TOTAL_SQL = """
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total
FROM orders GROUP BY o_custkey
"""


@register("total_by_key", _TOTAL_SQL)
def total_by_key(spark, sf):
    return agg.sum_by_key(T(spark, sf, "orders"), "o_custkey", "o_totalprice", "total", as_decimal=True)


@register("total_by_key_sorted", _TOTAL_SQL)
def total_by_key_sorted(spark, sf):
    return sort_by(total_by_key(spark, sf), "total", True, ["o_custkey"])


# --- projections, filters, SQL view on `part` (PRJ1-2, FLT2-3, AGG7, VW1) -------

@register("select_name", "SELECT p_name FROM part")
def select_name(spark, sf):
    return T(spark, sf, "part").select("p_name")


@register("filter_lt", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size < 21")
def filter_lt(spark, sf):
    return T(spark, sf, "part").filter(F.col("p_size") < 21).select("p_partkey", "p_name", "p_size")


@register("group_count", "SELECT p_size, count(*) AS count FROM part GROUP BY p_size")
def group_count(spark, sf):
    return T(spark, sf, "part").groupBy("p_size").count()


@register("add_constant", "SELECT p_name, p_size + 10 AS p_size_plus_10 FROM part")
def add_constant(spark, sf):
    p = T(spark, sf, "part")
    return p.select("p_name", (F.col("p_size") + 10).alias("p_size_plus_10"))


@register("sql_range", "SELECT * FROM part WHERE p_size >= 13 AND p_size <= 19")
def sql_range(spark, sf):
    T(spark, sf, "part").createOrReplaceTempView("part_view")
    return spark.sql("SELECT * FROM part_view WHERE p_size >= 13 AND p_size <= 19")


# --- keyless reduce, combineByKey, statistics (AGG15, AGG16, AGG18) -----------

@register("reduce_total", f"""
SELECT count(*) AS n, sum(l_extendedprice::DECIMAL(18,2)) AS sum_price,
       {R4('max(l_extendedprice)')} AS max_price, {R4('min(l_discount)')} AS min_discount
FROM lineitem
""")
def reduce_total(spark, sf):
    li = T(spark, sf, "lineitem")
    return agg.reduce_all(
        li, F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("sum_price"),
        round_half_up(F.max("l_extendedprice")).alias("max_price"),
        round_half_up(F.min("l_discount")).alias("min_discount"),
    )


@register("combine_by_key", f"""
SELECT l_returnflag, sum(l_extendedprice::DECIMAL(18,2)) AS sum_value, count(l_extendedprice) AS n,
       {R4('sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / count(l_extendedprice)')} AS mean_value
FROM lineitem GROUP BY l_returnflag
""")
def combine_by_key(spark, sf):
    return agg.combine_by_key(T(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")


def _two_dearest(a, b):
    """The first two of four (price, order, line), dearest first, and the rows counted."""
    some = sorted((x for x in (a[1:4], a[4:7], b[1:4], b[4:7]) if x[0] is not None), key=lambda x: (-x[0], x[1], x[2]))
    some = (some + [(None, None, None)] * 2)[:2]
    return (a[0] + b[0], *some[0], *some[1])


@register("two_dearest_lines", """
WITH r AS (SELECT l_returnflag, l_extendedprice AS p, l_orderkey AS o, l_linenumber AS n, row_number() OVER (PARTITION BY l_returnflag
             ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS k FROM lineitem)
SELECT l_returnflag, count(*) AS lines, max(p) FILTER (k = 1) AS price_1, max(o) FILTER (k = 1) AS order_1, max(n) FILTER (k = 1) AS line_1,
       max(p) FILTER (k = 2) AS price_2, max(o) FILTER (k = 2) AS order_2, max(n) FILTER (k = 2) AS line_2
FROM r GROUP BY l_returnflag
""")
def two_dearest_lines(spark, sf):
    """AGG16/UDF3: a combiner of tuples that no built-in aggregate has, merged in each task before three hot keys are shuffled."""
    none = [F.lit(None).cast(t).alias(c) for c, t in (("price_2", "double"), ("order_2", "bigint"), ("line_2", "int"))]
    li = T(spark, sf, "lineitem").select("l_returnflag", F.lit(1).cast("bigint").alias("lines"), F.col("l_extendedprice").alias("price_1"),
                                         F.col("l_orderkey").alias("order_1"), F.col("l_linenumber").alias("line_1"), *none)
    return reduce_by_key(li, ["l_returnflag"], li.columns[1:], _two_dearest)


@register("basic_statistics", f"""
SELECT count(*) AS n, {R4('avg(l_quantity)')} AS avg_l_quantity,
       {R4('avg(l_extendedprice)')} AS avg_l_extendedprice,
       {R4('var_pop(l_quantity)')} AS var_l_quantity,
       {R4('var_pop(l_extendedprice)')} AS var_l_extendedprice,
       {R4('stddev_samp(l_quantity)')} AS std_l_quantity,
       {R4('min(l_quantity)')} AS min_l_quantity, {R4('max(l_quantity)')} AS max_l_quantity,
       {R4('corr(l_quantity, l_extendedprice)')} AS corr_l_quantity_l_extendedprice
FROM lineitem
""")
def basic_statistics(spark, sf):
    return agg.basic_statistics(T(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
