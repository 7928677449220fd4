"""Engine-independent rounding of doubles for result comparison.

``round(x, 4)`` is implemented differently by engines (decimal text vs binary
value), so a value on a half-way point may round differently. ``floor(x *
10^d + 0.5) / 10^d`` is plain IEEE arithmetic, identical in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindling.functions.scalar import int_div

_WHOLE = 2.0 ** 52


def round_half_up(c, digits: int = 4) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    # From 2**52 on a double has no fraction left, and FLOOR's BIGINT would saturate.
    return F.when(F.abs(c * scale) < _WHOLE, F.floor(c * scale + 0.5) / scale).otherwise(c).cast("double")


def sql_round(expr: str, digits: int = 4) -> str:
    """The same rounding as SQL text (for the DuckDB oracle)."""
    scale = f"{10 ** digits}.0"
    return (f"CAST(CASE WHEN abs(({expr}) * {scale}) < {_WHOLE} THEN FLOOR(({expr}) * {scale} + 0.5) / {scale} "
            f"ELSE ({expr}) END AS DOUBLE)")


def hundredths_text(c, suffix: str = "") -> Column:
    """PRJ8 ``"%.2f"`` rendering, halves rounded away from zero.

    Built from the integer hundredths of the magnitude, with the sign before
    them, so both engines print the same digits.
    """
    c = F.col(c) if isinstance(c, str) else c
    cents = F.floor(F.abs(c) * 100.0 + 0.5).cast("bigint")
    return F.concat(
        F.when(c < 0, "-").otherwise(""), int_div(cents, F.lit(100)).cast("string"), F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"), F.lit(suffix),
    )


def sql_hundredths_text(expr: str, suffix: str = "") -> str:
    cents = f"CAST(FLOOR(abs({expr}) * 100.0 + 0.5) AS BIGINT)"
    return (
        f"(CASE WHEN ({expr}) < 0 THEN '-' ELSE '' END || CAST({cents} // 100 AS VARCHAR) || '.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0') || '{suffix}')"
    )
