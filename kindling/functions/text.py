"""String splitting with JVM ``String.split`` semantics, as Column expressions.

Trap T1: ``"a b ".split(" ")`` drops *trailing* empty strings but keeps
leading and interior ones; ``""`` yields one empty token; a string made only
of separators yields none. Spark's ``split`` keeps trailing empties, so we strip
trailing separators first. Everything stays a built-in expression (codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns used by the reference programs.
SPACE = " "
NON_WORD = r"\W+"
WHITESPACE = r"\s+"
LINE_BREAK = r"\r\n|\r|\n"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The same separators read backwards (for the linear trailing-run strip).
_REVERSED = {SPACE: SPACE, NON_WORD: NON_WORD, WHITESPACE: WHITESPACE, LINE_BREAK: r"\n\r|\r|\n"}


def strip_trailing(c, pattern: str) -> Column:
    """``c`` without its final run of separators.

    For the fixed patterns the run is removed from the reversed string with a
    ``^``-anchored possessive match: one start position, linear time even on
    a megabyte of trailing junk. Other patterns use ``(?:p)++\\z``.
    """
    c = _col(c)
    rev = _REVERSED.get(pattern)
    if rev is not None:
        return F.reverse(F.regexp_replace(F.reverse(c), f"^(?:{rev})++", ""))
    # \z (not $): true end of input; ``++`` never backtracks into the run.
    return F.regexp_replace(c, f"(?:{pattern})++\\z", "")


# A value made only of separators has no character of this class (fixed patterns).
_NON_SEPARATOR = {SPACE: "[^ ]", NON_WORD: r"\w", WHITESPACE: r"\S", LINE_BREAK: r"[^\r\n]"}


def only_separators(c, pattern: str) -> Column:
    """True when the non-empty ``c`` is one run of separators (JVM split gives no token).

    For the fixed patterns this is an unanchored search for one
    non-separator character, which stops at the first hit; other patterns
    strip the trailing run and compare with ``''``.
    """
    c = _col(c)
    other = _NON_SEPARATOR.get(pattern)
    if other is not None:
        return ~c.rlike(other)
    return strip_trailing(c, pattern) == ""


def java_split(c, pattern: str) -> Column:
    """Split ``c`` on regex ``pattern`` exactly like JVM ``String.split(pattern)``.

    The trailing-run strip appears once, in the branch that splits, so it is
    evaluated once per row."""
    c = _col(c)
    return (
        F.when(c.isNull(), F.lit(None))
        .when(c == "", F.array(F.lit("")))
        .when(only_separators(c, pattern), F.array().cast("array<string>"))
        .otherwise(F.split(strip_trailing(c, pattern), pattern, -1))
    )


def split_lines(c) -> Column:
    """Lines of a text value; a final line break does not open an empty line."""
    return java_split(c, LINE_BREAK)


def unicode_pattern(pattern: str) -> str:
    """Make ``\\w``/``\\W``/``\\s`` Unicode-aware (trap T2 option)."""
    return "(?U)" + pattern


def explode_split(df, column: str, pattern: str, out: str, keep=()):
    """One row per JVM-``split`` token of ``column`` (plus the ``keep`` columns).

    The stripped value is computed once in its own projection (Catalyst does
    not merge projections that would repeat an expensive expression), rather
    than once per CASE branch as in ``java_split``.
    """
    keep = list(keep)
    s = df.select(*keep, F.col(column).alias("_c"), strip_trailing(F.col(column), pattern).alias("_s"))
    tokens = (
        F.when(F.col("_c") == "", F.array(F.lit("")))
        .when(F.col("_s") == "", F.array().cast("array<string>"))
        .otherwise(F.split(F.col("_s"), pattern, -1))
    )
    return s.filter(F.col("_c").isNotNull()).select(*keep, F.explode(tokens).alias(out))
