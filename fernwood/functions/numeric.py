"""Scalar numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column, default: float = 0.0) -> Column:
    """``num / den`` in double; ``default`` when ``den`` is zero (the 0/0 → 0 rule)."""
    return F.when(den == 0, F.lit(float(default))).otherwise(
        num.cast("double") / den.cast("double"))


def rounded(c: Column, digits: int = 6) -> Column:
    """Round a double for stable comparison of results across engines."""
    return F.round(c.cast("double"), digits)
