"""Delimited-text sources with explicit schemas (SRC2-SRC7, SRC11).

All readers take a schema as DDL and a malformed-row ``mode``:
``FAILFAST`` (the reference's ``toInt`` throws) or ``DROPMALFORMED``
(the reference's name loaders skip bad lines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed input shapes of the programs (FIXTURES.md §1).
PEOPLE_SCHEMA = "id INT, name STRING, age INT, num_friends INT"
WEATHER_SCHEMA = "station STRING, date STRING, type STRING, value DOUBLE"
CUSTOMER_ORDERS_SCHEMA = "customer INT, item INT, amount DOUBLE"
RATINGS_SCHEMA = "user INT, item INT, rating DOUBLE, ts BIGINT"
ITEMS_SCHEMA = "item INT, name STRING"
POINTS_SCHEMA = "label DOUBLE, feature DOUBLE"


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str,
    sep: str = ",",
    mode: str = "FAILFAST",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Headerless delimited text with a fixed schema.

    Extra trailing fields are ignored; multi-character separators work.
    """
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", "false")
        .option("mode", mode)
        .option("encoding", encoding)
        .csv(path)
    )


def read_people(spark, path, mode="FAILFAST") -> DataFrame:
    """SRC2: ``id,name,age,numFriends``."""
    return read_delimited(spark, path, PEOPLE_SCHEMA, ",", mode)


def read_weather(spark, path, mode="FAILFAST") -> DataFrame:
    """SRC3: ``station,date,type,value,...``; keeps station, type, value."""
    return read_delimited(spark, path, WEATHER_SCHEMA, ",", mode).select(
        "station", "type", "value"
    )


def read_customer_orders(spark, path, mode="FAILFAST") -> DataFrame:
    """SRC4: ``customer,item,amount``; keeps customer and amount."""
    return read_delimited(spark, path, CUSTOMER_ORDERS_SCHEMA, ",", mode).select(
        "customer", "amount"
    )


def read_ratings(spark, path, sep="\t", mode="FAILFAST") -> DataFrame:
    """SRC5 (tab) and SRC7 (``::``): ``user,item,rating[,ts]``."""
    return read_delimited(spark, path, RATINGS_SCHEMA, sep, mode)


def read_items(spark, path, sep="|", encoding="UTF-8") -> DataFrame:
    """SRC6/SRC7: item dimension ``id<sep>name<sep>...``.

    Invalid bytes become the replacement character; rows with fewer than two
    fields (null name) or an unparsable id are dropped, as the reference does.
    """
    df = read_delimited(spark, path, ITEMS_SCHEMA, sep, "PERMISSIVE", encoding)
    return df.filter(F.col("item").isNotNull() & F.col("name").isNotNull())


def read_items_last(spark, path, sep="|", encoding="UTF-8") -> DataFrame:
    """SRC6 as a map filled row by row: of rows with one id, the last in the
    files wins (files in the order of their paths, rows in their order in the file).

    A scan task reads a block of a file from its start, so a row's place is its file's path, its block's start and its
    number in the task; the last one of an id is a partial aggregate, and no file is read by one task alone."""
    df = read_delimited(spark, path, ITEMS_SCHEMA, sep, "PERMISSIVE", encoding)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    df = df.select("item", "name", place.alias("place")).filter(F.col("item").isNotNull() & F.col("name").isNotNull())
    return df.groupBy("item").agg(F.max_by("name", "place").alias("name"))


def read_friend_counts(spark, path, mode="FAILFAST") -> DataFrame:
    """SRC2b: ``name`` and number of friends of the people file; the other fields are not read."""
    return read_people(spark, path, mode).select("name", "num_friends")


def read_points(spark, path, mode="FAILFAST") -> DataFrame:
    """SRC11: ``label,feature`` labelled points."""
    return read_delimited(spark, path, POINTS_SCHEMA, ",", mode)
