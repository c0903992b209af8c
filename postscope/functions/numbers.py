"""Narrowing numbers the way the original record types hold them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1


def java_int(x: Column) -> Column:
    """Number -> int: truncate toward zero, saturate at the int range, NaN -> 0,
    NULL stays NULL (ANSI casts would fail the job instead)."""
    d = x.cast("double")
    clamped = F.least(F.greatest(d, F.lit(float(INT_MIN))), F.lit(float(INT_MAX)))
    return F.when(F.isnan(d), F.lit(0)).when(d.isNotNull(), clamped.cast("int"))


def text_int(c: Column) -> Column:
    """Text of a number (``12``, ``12.7``, ``1e3``) -> int as :func:`java_int`; anything else 0."""
    return F.coalesce(java_int(c.try_cast("double")), F.lit(0))


def text_long(c: Column) -> Column:
    """Text of a number -> long; whole numbers stay exact, decimals truncate, anything else 0."""
    d = c.try_cast("double")
    far = F.lit(float(2 ** 63 - 1024))
    whole = F.when(d.isNotNull() & ~F.isnan(d), F.least(F.greatest(d, -far), far).cast("bigint"))
    return F.coalesce(c.try_cast("bigint"), whole, F.lit(0).cast("bigint"))
