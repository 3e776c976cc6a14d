"""Null-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, null when b is zero."""
    return F.try_divide(a, b)


def pct(a: Column, b: Column) -> Column:
    """a as a percentage of b."""
    return ratio(a, b) * 100


def rescale(c: Column, factor: float) -> Column:
    """Change of unit, such as thousands to billions with 1e6."""
    return c / F.lit(float(factor))


def log_value(c: Column) -> Column:
    """Natural log, null for what is not positive."""
    return F.when(c > 0, F.ln(c))


def round_even(c: Column, digits: int = 0) -> Column:
    """Round with ties to the even digit."""
    return F.bround(c, digits)


def if_known(cond: Column, yes: Column, no: Column) -> Column:
    """Conditional value that is null when the condition is."""
    return F.when(cond, yes).when(~cond, no)
