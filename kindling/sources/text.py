"""Line-oriented text sources (SRC1, SRC9, SRC10, SRC12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.functions.text import WHITESPACE, java_split


def read_lines(spark: SparkSession, path: str, column: str = "line") -> DataFrame:
    """SRC1: one row per line. The path may be ``file://``, ``s3a://`` ... (SRC8)."""
    return spark.read.text(path).withColumnRenamed("value", column)


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """SRC12: one word per line -> distinct ``word`` keys."""
    return read_lines(spark, path, "word").filter(F.col("word") != "").distinct()


def _tokens(lines: DataFrame, column: str) -> DataFrame:
    """``t``: the ``\\s+`` tokens of each trimmed line, computed once per line.

    The split is the argument of a generator, so filters on ``t`` stay above
    it; as a projected alias Catalyst would copy the split into every
    pushed-down filter and evaluate it once per reference.
    """
    tokens = java_split(F.trim(F.col(column)), WHITESPACE)
    return lines.select(F.inline(F.array(F.struct(tokens.alias("t")))))


def adjacency_to_edges(lines: DataFrame, column: str = "line") -> DataFrame:
    """SRC9: ``id n1 n2 ...`` lines (an id may span lines) -> ``src, dst`` edges.

    Split on ``\\s+`` (trap T11); malformed numbers raise, like the reference.
    """
    parsed = _tokens(lines, column).filter(F.size("t") >= 1).filter(F.col("t")[0] != "")
    return parsed.select(
        F.col("t")[0].cast("bigint").alias("src"),
        F.explode(F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0)))).alias("dst"),
    ).select("src", F.col("dst").cast("bigint").alias("dst"))


def adjacency_line_degrees(lines: DataFrame, column: str = "line") -> DataFrame:
    """Per line: ``id`` and its neighbour count (``size - 1``, FN8)."""
    parsed = _tokens(lines, column).filter(F.size("t") >= 1).filter(F.col("t")[0] != "")
    return parsed.select(
        F.col("t")[0].cast("bigint").alias("id"),
        (F.size("t") - 1).cast("bigint").alias("n"),
    )


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    return adjacency_to_edges(read_lines(spark, path))


# Fixed pattern: an id, whitespace, then a double-quoted name.
QUOTED_NAME = r'^\s*(\d+)\s+"([^"]*)"'


def parse_quoted_names(lines: DataFrame, column: str = "line", max_id: int | None = None) -> DataFrame:
    """SRC10: ``id "NAME"`` lines -> ``id, name``; lines without quotes are dropped."""
    ok = lines.filter(F.col(column).rlike(QUOTED_NAME))
    out = ok.select(
        F.regexp_extract(column, QUOTED_NAME, 1).cast("bigint").alias("id"),
        F.regexp_extract(column, QUOTED_NAME, 2).alias("name"),
    )
    if max_id is not None:
        out = out.filter(F.col("id") < max_id)
    return out


def read_quoted_names(spark: SparkSession, path: str, max_id: int | None = None) -> DataFrame:
    return parse_quoted_names(read_lines(spark, path), max_id=max_id)
