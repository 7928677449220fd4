"""Source/sink round trips (SRC1, SRC2-SRC7, SRC14-SRC16, SNK5, SNK9) and UDFs (UDF1, UDF2).

Each round trip writes a driver table with Spark into a fresh folder below
the shared checkpoint folder and reads it back with an explicit schema.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kindling.operators.udfs import map_rows, register_square, square
from kindling.plans.common import T
from kindling.plans.fixtures import document_lines
from kindling.session import scratch_path
from kindling.sources.delimited import (read_customer_orders, read_delimited, read_friend_counts, read_items_last, read_people, read_points, read_ratings,
                                         read_weather)
from kindling.sources.formats import read_json
from kindling.sources.sinks import describe_schema, save_sorted, write_table
from kindling.sources.tables import read_catalog_table, read_parquet
from kindling.sources.text import read_lines, read_quoted_names, read_stopwords

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


CUSTOMER_DDL = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")


@register("roundtrip_csv", "SELECT * FROM customer")
def roundtrip_csv(spark, sf):
    path = scratch_path(spark, "customer-csv")
    write_table(T(spark, sf, "customer"), path, "csv")
    return read_delimited(spark, path, CUSTOMER_DDL, ",", "FAILFAST")


@register("roundtrip_pipe", "SELECT * FROM customer")
def roundtrip_pipe(spark, sf):
    """SRC6/SRC7 shapes: `|` and multi-character `::` separators."""
    path = scratch_path(spark, "customer-psv")
    T(spark, sf, "customer").write.option("sep", "::").csv(path)
    return read_delimited(spark, path, CUSTOMER_DDL, "::", "FAILFAST")


@register("roundtrip_json", "SELECT * FROM orders")
def roundtrip_json(spark, sf):
    path = scratch_path(spark, "orders-json")
    write_table(T(spark, sf, "orders"), path, "json")
    return read_json(spark, path, ORDERS_DDL)


@register("roundtrip_sorted_parquet", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem")
def roundtrip_sorted_parquet(spark, sf):
    """SNK5: range-partitioned sorted save, read back."""
    path = scratch_path(spark, "lineitem-sorted")
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    save_sorted(li, path, ["l_orderkey", "l_linenumber"])
    return read_parquet(spark, path)


@register("roundtrip_table", "SELECT * FROM supplier")
def roundtrip_table(spark, sf):
    """SNK9 + SRC15: save as a catalog table stored in the shared folder, read by name."""
    path = scratch_path(spark, "supplier-table")
    name = "kindling_supplier_" + path.rsplit("-", 1)[-1]
    T(spark, sf, "supplier").write.mode("overwrite").option("path", path).saveAsTable(name)
    return read_catalog_table(spark, name)


@register("roundtrip_text_lines", r"""
SELECT unnest(CASE WHEN text = '' THEN [''] WHEN regexp_replace(text, '(?:\r\n|\r|\n)+\z', '') = '' THEN []::VARCHAR[]
       ELSE string_split_regex(regexp_replace(text, '(?:\r\n|\r|\n)+\z', ''), '\r\n|\r|\n') END) AS line
FROM documents
""")
def roundtrip_text_lines(spark, sf):
    """SRC1: document lines written as a text file and scanned back, one row per line."""
    path = scratch_path(spark, "doc-lines")
    document_lines(spark, sf).select("line").write.text(path)
    return read_lines(spark, path, "line")


@register("items_last_wins", """
SELECT (p_partkey % (SELECT max(p_partkey) // 4 + 1 FROM part))::INT AS item, arg_max(p_name, p_partkey) AS name FROM part GROUP BY 1
""")
def items_last_wins(spark, sf):
    """SRC6: parts written as `|` files in the order of their keys, about four rows an id; the last row of an id is its name."""
    part = T(spark, sf, "part").select("p_partkey", "p_name")
    n = part.agg(F.expr("max(p_partkey) div 4 + 1")).first()[0]
    path = scratch_path(spark, "items-psv")
    rows = part.repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey")
    rows.select((F.col("p_partkey") % F.lit(n)).alias("item"), "p_name", F.lit("x").alias("rest")).write.option("sep", "|").csv(path)
    return read_items_last(spark, path)


def _people_file(spark, sf):
    path = scratch_path(spark, "people-csv")
    c = T(spark, sf, "customer")
    c.select("c_custkey", "c_name", (F.col("c_nationkey") + 18).alias("age"), F.length("c_mktsegment")).write.option("lineSep", "\n").csv(path)
    return path


@register("people_by_age", """
SELECT c_nationkey + 18 AS age, count(*) AS people, sum(length(c_mktsegment)) AS friends FROM customer GROUP BY 1
""")
def people_by_age(spark, sf):
    """SRC2: a people file written from customers, read back by its fixed shape."""
    return read_people(spark, _people_file(spark, sf)).groupBy("age").agg(F.count(F.lit(1)).alias("people"), F.sum("num_friends").alias("friends"))


@register("people_friend_counts", "SELECT c_name AS name, length(c_mktsegment)::INT AS num_friends FROM customer")
def people_friend_counts(spark, sf):
    """SRC2b: names and friend counts of that file."""
    return read_friend_counts(spark, _people_file(spark, sf))


@register("weather_extremes", """
SELECT event_type AS type, count(*) AS n, min(round(value)) AS low, max(round(value)) AS high FROM events GROUP BY 1
""")
def weather_extremes(spark, sf):
    """SRC3: observations with further fields behind, of which station, type and value are kept."""
    path = scratch_path(spark, "weather-csv")
    ev = T(spark, sf, "events")
    ev.select(F.concat(F.lit("ST"), F.col("user_id")), F.date_format("ts", "yyyyMMdd"), "event_type", F.round("value"), F.lit(""), F.lit("Q")).write.csv(path)
    return read_weather(spark, path).groupBy("type").agg(F.count("station").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))


@register("spent_by_customer_file", """
SELECT o_custkey::INT AS customer, sum(o_totalprice::DECIMAL(18,2)) AS spent FROM orders GROUP BY 1
""")
def spent_by_customer_file(spark, sf):
    """SRC4: orders as `customer,item,amount` lines, summed as money."""
    path = scratch_path(spark, "orders-csv")
    T(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice").write.csv(path)
    spent = F.sum(F.col("amount").cast("decimal(18,2)")).cast("decimal(38,2)")
    return read_customer_orders(spark, path).groupBy("customer").agg(spent.alias("spent"))


@register("ratings_histogram_file", """
SELECT l_linenumber::DOUBLE AS rating, count(*) AS n, count(DISTINCT l_suppkey) AS users, max(epoch_us(l_shipdate) // 1000000) AS last_ts FROM lineitem GROUP BY 1
""")
def ratings_histogram_file(spark, sf):
    """SRC5: tab-separated ratings."""
    path = scratch_path(spark, "ratings-tsv")
    li = T(spark, sf, "lineitem")
    li.select("l_suppkey", "l_partkey", "l_linenumber", F.unix_seconds(F.col("l_shipdate").cast("timestamp"))).write.option("sep", "\t").csv(path)
    return read_ratings(spark, path).groupBy("rating").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user").alias("users"), F.max("ts").alias("last_ts"))


@register("quoted_names_file", "SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_suppkey < 6487 AND s_suppkey % 7 <> 0")
def quoted_names_file(spark, sf):
    """SRC10: `id "NAME"` lines; lines without quotes are dropped, ids are below the bound."""
    path = scratch_path(spark, "names-text")
    name = F.when(F.col("s_suppkey") % 7 == 0, F.col("s_name")).otherwise(F.concat(F.lit('"'), F.col("s_name"), F.lit('"')))
    T(spark, sf, "supplier").select(F.concat_ws(" ", F.col("s_suppkey").cast("string"), name)).write.text(path)
    return read_quoted_names(spark, path, max_id=6487)


@register("points_file", "SELECT count(*) AS n, sum(l_linenumber)::DOUBLE AS labels, sum(l_quantity) AS features FROM lineitem")
def points_file(spark, sf):
    """SRC11: labelled points."""
    path = scratch_path(spark, "points-csv")
    T(spark, sf, "lineitem").select("l_linenumber", "l_quantity").write.csv(path)
    return read_points(spark, path).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("labels"), F.sum("feature").alias("features"))


@register("stopword_file", "SELECT DISTINCT lower(w) AS word FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark) WHERE regexp_full_match(w, '[A-Za-z]+')")
def stopword_file(spark, sf):
    """SRC12: a stop-word file written with repeats and empty lines, read as a set."""
    path = scratch_path(spark, "stop-text")
    words = T(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("w")).where(F.col("w").rlike("^[A-Za-z]+$")).select(F.lower("w").alias("w"))
    words.unionByName(words.select(F.lit("").alias("w"))).write.text(path)
    return read_stopwords(spark, path)


_SCHEMA = ("l_orderkey bigint", "l_partkey bigint", "l_suppkey bigint", "l_linenumber int", "l_quantity double", "l_extendedprice double", "l_discount double",
           "l_tax double", "l_returnflag string", "l_linestatus string", "l_shipdate timestamp_ntz")


@register("describe_schema", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c.split()[0]}' AS column_name, '{c.split()[1]}' AS data_type, count({c.split()[0]}) AS held FROM lineitem"
    for i, c in enumerate(_SCHEMA)))
def q_describe_schema(spark, sf):
    """SNK4: the columns of ``lineitem`` as rows, each with the number of rows that hold a value there."""
    li = T(spark, sf, "lineitem")
    held = li.agg(*(F.count(c).alias(c) for c in li.columns)).unpivot([], li.columns, "column_name", "held")
    return describe_schema(li).join(F.broadcast(held), "column_name").select("position", "column_name", "data_type", "held")


@register("udf_square", "SELECT p_partkey, CAST(p_size AS BIGINT) * p_size AS p_size_sq FROM part")
def udf_square(spark, sf):
    """UDF1 (Pandas UDF, also registered for SQL)."""
    register_square(spark)
    p = T(spark, sf, "part")
    return p.select("p_partkey", square(F.col("p_size")).alias("p_size_sq"))


@register("udf_map_rows", """
SELECT p_partkey, upper(p_brand) AS brand, p_retailprice * 2 AS double_price FROM part
""")
def udf_map_rows(spark, sf):
    """UDF2: a row mapper over Arrow batches (``mapInPandas``)."""
    p = T(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")

    def fn(pdf):
        return pdf.assign(brand=pdf["p_brand"].str.upper(), double_price=pdf["p_retailprice"] * 2)[
            ["p_partkey", "brand", "double_price"]]

    return map_rows(p, fn, "p_partkey BIGINT, brand STRING, double_price DOUBLE")
