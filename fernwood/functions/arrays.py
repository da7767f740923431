"""Array expressions: argmax, softmax, Euclidean distance.

All are higher-order built-ins (``transform``, ``aggregate``, ``zip_with``),
so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax(arr: Column) -> Column:
    """0-based index of the first maximum of a numeric array (class prediction)."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def softmax(arr: Column) -> Column:
    """Numerically stable softmax of a numeric array, in double."""
    shifted = F.transform(arr, lambda x: F.exp(x.cast("double") - F.array_max(arr).cast("double")))
    total = F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(shifted, lambda x: x / total)


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance between two equal-length numeric arrays."""
    diffs = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x)
