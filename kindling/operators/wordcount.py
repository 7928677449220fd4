"""Word counts over text lines (FN1, FN2, FN4, PRJ5, AGG1, JOIN5).

Tokens are produced by built-in ``split``/``explode`` (whole-stage codegen)
and counted with a partial aggregate: a word that makes up a third of all
tokens costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.functions.text import NON_WORD, SPACE, explode_split
from kindling.operators.lookup import anti_join


def tokenize(lines: DataFrame, column: str = "line", pattern: str = SPACE, lower: bool = False,
             drop_empty: bool = False, out: str = "word") -> DataFrame:
    """One row per token of every line, JVM ``split`` semantics (T1).

    Empty tokens are kept by default: the reference counts them.
    """
    tok = explode_split(lines, column, pattern, out)
    if lower:
        tok = tok.select(F.lower(out).alias(out))
    if drop_empty:
        tok = tok.filter(F.col(out) != "")
    return tok


def word_count(lines: DataFrame, column: str = "line", pattern: str = SPACE, lower: bool = False,
               drop_empty: bool = False) -> DataFrame:
    """(word, count) over all lines."""
    tok = tokenize(lines, column, pattern, lower, drop_empty)
    return tok.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def word_count_without(lines: DataFrame, stopwords: DataFrame, column: str = "line",
                       pattern: str = NON_WORD, lower: bool = True) -> DataFrame:
    """Word counts minus a stop list (``subtractByKey``), ascending by count.

    The anti-join broadcasts the stop list only if it is proven small.
    """
    counts = word_count(lines, column, pattern, lower)
    kept = anti_join(counts, stopwords.select(F.col(stopwords.columns[0]).alias("word")), "word")
    return kept.orderBy(F.col("count").asc(), F.col("word").asc())
