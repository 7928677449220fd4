"""Derived inputs built by Spark from the driver tables (FIXTURES.md §4).

Every fixture is a lazy DataFrame over the given tables, so its size grows
with them; nothing is synthesised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.functions.text import LINE_BREAK, explode_split
from kindling.operators.sizing import spread
from kindling.sources.tables import table


def ratings(spark: SparkSession, sf_dir: str, item: str = "l_suppkey") -> DataFrame:
    """R(user, item, rating): customer x item, mean quantity over their lines.

    ``lineitem`` joins ``orders`` on the order key (both sides shuffle on the
    key, or the orders side is broadcast by AQE when small); the aggregate is
    partial before its shuffle.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col(item).alias("item"), "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .groupBy(F.col("o_custkey").alias("user"), "item")
        .agg(F.avg("l_quantity").alias("rating"))
    )


def timed_ratings(spark: SparkSession, sf_dir: str, item: str = "l_suppkey") -> DataFrame:
    """R with ``ts``: the first order date of each (user, item)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col(item).alias("item"), "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .groupBy(F.col("o_custkey").alias("user"), "item")
        .agg(F.avg("l_quantity").alias("rating"), F.min("o_orderdate").alias("ts"))
    )


def graph_edges(spark: SparkSession, sf_dir: str, distinct: bool = True) -> DataFrame:
    """Supplier-part graph of all lines, both directions, distinct unless that is left to the caller.

    Supplier ``s`` is vertex ``2*s``; part ``p`` is vertex ``2*p+1``.
    """
    li = table(spark, sf_dir, "lineitem")
    a = (F.col("l_suppkey") * 2).cast("bigint")
    b = (F.col("l_partkey") * 2 + 1).cast("bigint")
    fwd = li.select(a.alias("src"), b.alias("dst"))
    back = li.select(b.alias("src"), a.alias("dst"))
    both = fwd.unionByName(back)
    return both.distinct() if distinct else both


def graph_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertex names: ``S<suppkey>`` from supplier, ``P<partkey>`` from part."""
    s = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 2).cast("bigint").alias("id"), F.col("s_name").alias("name")
    )
    p = table(spark, sf_dir, "part").select(
        (F.col("p_partkey") * 2 + 1).cast("bigint").alias("id"), F.col("p_name").alias("name")
    )
    return s.unionByName(p)


def graph_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-row frame with the BFS root: the smallest supplier vertex in the graph."""
    li = table(spark, sf_dir, "lineitem")
    return li.agg((F.min("l_suppkey") * 2).cast("bigint").alias("root"))


def hashtag_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, tag): ``'#' || event_type`` with the event time as ``timestamp`` (T13)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("#"), F.col("event_type")).alias("tag"),
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line of every document's text."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return explode_split(d, "text", LINE_BREAK, "line", keep=["doc_id"])
