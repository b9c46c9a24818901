"""Fixed-point helpers.

The reference stores values as NUMERIC. Rounding binary doubles gives
different answers between engines at ties, so every rounded value here is
cast to ``decimal(38,9)`` first, rounded half-up, and kept as decimal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = "decimal(38,9)"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def numeric(x: Column | str) -> Column:
    return _c(x).cast(NUMERIC)


def fixed(x: Column | str, digits: int | None = None) -> Column:
    """``CAST(ROUND(CAST(x AS NUMERIC), digits) AS NUMERIC)``."""
    v = numeric(x)
    if digits is not None:
        v = F.round(v, digits).cast(NUMERIC)
    return v


# Operand types for division. Spark sizes a decimal quotient from its
# operands' precision and, past 38 digits, cuts the scale (to 6 for two
# decimal(38,9)). With a decimal(24,9) dividend (15 integer digits) and an
# integral decimal(19,0) divisor the quotient keeps 22+ decimals, so the one
# half-up rounding below is exact for the digits kept.
DIVIDEND = "decimal(24,9)"
DIVISOR = "decimal(19,0)"


def exact_div(num: Column | str, den: Column | str, digits: int = 9) -> Column:
    """``ROUND(num / den, digits)`` half-up on the exact quotient, as NUMERIC.

    ``den`` must be integral (hours, counts); NULL when it is 0 or NULL.
    """
    d = _c(den).cast(DIVISOR)
    q = _c(num).cast(DIVIDEND) / F.nullif(d, F.lit(0).cast(DIVISOR))
    return F.round(q, digits).cast(NUMERIC)


def safe_ratio(num: Column | str, den: Column | str, digits: int | None = None) -> Column:
    """``ROUND(num / NULLIF(den, 0), digits)`` as NUMERIC; ``den`` integral."""
    return exact_div(num, den, 9 if digits is None else digits)


def percent(num: Column, den: Column, digits: int = 1) -> Column:
    """``ROUND(num * 100.0 / den, digits)`` with an empty-input guard."""
    return exact_div(_c(num).cast(DIVIDEND) * 100, den, digits)
