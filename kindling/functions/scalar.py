"""Small scalar Column helpers (PRJ7, PRJ8, FN7-FN9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den, default: float = 0.0) -> Column:
    """FN9: ``num / den`` or ``default`` when the denominator is 0 (ANSI-safe)."""
    num, den = _col(num), _col(den)
    return F.when(den != 0, num / den).otherwise(F.lit(default))


def tenths_celsius_to_fahrenheit(c) -> Column:
    """PRJ7: tenths of a degree Celsius to Fahrenheit, ``x*0.1*(9/5)+32``."""
    return _col(c).cast("double") * 0.1 * (9.0 / 5.0) + 32.0


def fixed_2dp(c, suffix: str = "") -> Column:
    """PRJ8: fixed two-decimal rendering with a suffix, e.g. ``"%.2f F"``."""
    return F.format_string("%.2f" + suffix, _col(c))


def int_div(num, den) -> Column:
    """T3: integer division truncating toward zero (``-7 div 2`` is ``-3``).

    Null when the denominator is 0 instead of raising.
    """
    n = _col(num).cast("bigint")
    d = _col(den).cast("bigint")
    return F.when(d != 0, F.call_function("div", n, d))

