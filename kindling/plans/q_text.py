"""Word counts over `documents` (FN1, FN2, FN4, PRJ5, AGG1, JOIN5, T1, T2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindling.functions.text import NON_WORD, SPACE, java_split
from kindling.operators.wordcount import tokenize, word_count, word_count_without
from kindling.plans.common import LINES_CTE, T, sql_java_split
from kindling.plans.fixtures import document_lines

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("word_count_space", f"""
WITH {LINES_CTE},
words AS (SELECT unnest({sql_java_split('line', ' ')}) AS word FROM lines)
SELECT word, count(*) AS count FROM words GROUP BY word
""")
def word_count_space(spark, sf):
    return word_count(document_lines(spark, sf), "line", SPACE)


@register("word_count_regex", f"""
WITH {LINES_CTE},
words AS (SELECT lower(unnest({sql_java_split('line', chr(92) + 'W+')})) AS word FROM lines)
SELECT word, count(*) AS count FROM words GROUP BY word
""")
def word_count_regex(spark, sf):
    return word_count(document_lines(spark, sf), "line", NON_WORD, lower=True)


def _stopwords(spark, sf):
    """Stop list: the distinct lower-cased tokens of `benchmark` (same tokenizer)."""
    b = T(spark, sf, "benchmark")
    lines = b.select(F.explode(java_split(F.col("text"), r"\r\n|\r|\n")).alias("line"))
    return tokenize(lines, "line", NON_WORD, lower=True).distinct()


@register("word_count_nostop_sorted", f"""
WITH {LINES_CTE},
words AS (SELECT lower(unnest({sql_java_split('line', chr(92) + 'W+')})) AS word FROM lines),
blines AS (SELECT unnest({sql_java_split('text', chr(92) + 'r' + chr(92) + 'n|' + chr(92) + 'r|' + chr(92) + 'n')}) AS line FROM benchmark),
stop AS (SELECT DISTINCT lower(unnest({sql_java_split('line', chr(92) + 'W+')})) AS word FROM blines)
SELECT word, count(*) AS count FROM words
WHERE word NOT IN (SELECT word FROM stop)
GROUP BY word
""")
def word_count_nostop_sorted(spark, sf):
    return word_count_without(document_lines(spark, sf), _stopwords(spark, sf), "line", NON_WORD, lower=True)
