"""Sinks and inspection actions (SNK4, SNK5, SNK9, SNK10, SNK11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.operators.sizing import small_frame


def describe_schema(df: DataFrame) -> DataFrame:
    """SNK4: the schema as rows ``(position, column, data_type, nullable)``.

    Built from the (small, fixed) schema, not from the data.
    """
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(df.schema.fields)
    ]
    spark = df.sparkSession
    return small_frame(
        spark, rows, "position INT, column_name STRING, data_type STRING, nullable BOOLEAN"
    )


def save_sorted(df: DataFrame, path: str, keys: list[str], fmt: str = "parquet", mode: str = "overwrite") -> None:
    """SNK5: range-partitioned, sorted write (``sortByKey().saveAsTextFile``)."""
    df.orderBy(*keys).write.mode(mode).format(fmt).save(path)


def write_table(df: DataFrame, path_or_name: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """SNK9: json / parquet / csv files, or ``fmt="table"`` for a catalog table."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "table":
        writer.saveAsTable(path_or_name)
    else:
        writer.format(fmt).save(path_or_name)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None) -> None:
    """Batch JDBC write; each partition writes over its own connection."""
    df.write.jdbc(url, table, mode=mode, properties=dict(properties or {}))


def jdbc_batch_writer(url: str, table: str, properties: dict | None = None):
    """SNK10: Spark has no JDBC stream sink; ``foreachBatch`` writes each batch.

    Rows carry ``batch_id`` so a retried batch can be deleted and re-written.
    """
    props = dict(properties or {})

    def _write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.jdbc(
            url, table, mode="append", properties=props
        )

    return _write


def top_n(df: DataFrame, n: int, *order) -> DataFrame:
    """SNK11: ``take(n)`` as a lazy, ordered ``limit``."""
    return df.orderBy(*order).limit(n)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """VW1: register ``df`` for ``spark.sql``."""
    df.createOrReplaceTempView(name)
    return df


def sql(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(text)
