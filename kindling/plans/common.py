"""Shared helpers for the registered queries and their DuckDB oracles."""

from __future__ import annotations

from kindling.functions.rounding import sql_round
from kindling.sources.tables import table as _table


def T(spark, sf_dir, name):
    return _table(spark, sf_dir, name)


def sql_java_split(expr: str, pattern: str) -> str:
    """DuckDB form of ``kindling.functions.text.java_split`` (trap T1)."""
    stripped = f"regexp_replace({expr}, '(?:{pattern})+\\z', '')"
    return (
        f"(CASE WHEN {expr} IS NULL THEN NULL WHEN {expr} = '' THEN [''] "
        f"WHEN {stripped} = '' THEN []::VARCHAR[] "
        f"ELSE string_split_regex({stripped}, '{pattern}') END)"
    )


LINES_CTE = (
    "lines AS (SELECT doc_id, unnest("
    + sql_java_split("text", r"\r\n|\r|\n")
    + ") AS line FROM documents)"
)

R4 = sql_round
