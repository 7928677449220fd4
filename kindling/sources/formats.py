"""JSON, JDBC and file-stream sources (SRC14, SRC17, SRC18)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """SRC14: JSON lines. Pass a schema in production to skip inference."""
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    return reader.json(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """SRC17: a JDBC table; give a partition column to read it in parallel."""
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(
            url, table, column=partition_column, lowerBound=lower_bound,
            upperBound=upper_bound, numPartitions=num_partitions, properties=props,
        )
    return spark.read.jdbc(url, table, properties=props)


def read_json_stream(spark: SparkSession, path: str, schema: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC18: a folder of JSON-lines files as a stream (schema required)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, schema: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A driver parquet table read as a file stream (SRC13 stand-in).

    A table is one file or a folder of part files; a stream needs a folder or a
    glob, and the glob ``<name>.parquet*`` matches either. A table that is not
    there is an error, not an empty stream.
    """
    spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")  # resolves the path
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{sf_dir}/{name}.parquet*")
