"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from fernwood.functions.arrays import argmax, softmax, squared_distance
from fernwood.functions.hashing import unit_draw, hash32
from fernwood.functions.numeric import safe_div, rounded

__all__ = [
    "argmax",
    "softmax",
    "squared_distance",
    "unit_draw",
    "hash32",
    "safe_div",
    "rounded",
]
