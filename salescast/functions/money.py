"""Money arithmetic.

Money is accumulated as DECIMAL so sums are exact and rounding is HALF_UP on
exact values; only the rounded result is turned back into DOUBLE. Summing the
doubles directly would make the 2-dp day totals depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)  # one amount, 4 dp as landed
ACC = T.DecimalType(28, 4)  # an accumulator of amounts


def dec(c: Column | str) -> Column:
    """A money value (double or integer) as an exact 4-dp decimal."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def zero() -> Column:
    return F.lit(0).cast(ACC)


def money_sum(c: Column | str) -> Column:
    """Exact SUM of a money column (NULL when every input is NULL, like SQL)."""
    return F.sum(dec(c))


def rounded(c: Column, dp: int) -> Column:
    """round(x, dp) on the exact decimal, returned as DOUBLE."""
    return F.round(c, dp).cast(T.DoubleType())
