"""Null-safe validity predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_negative(name: str) -> Column:
    """``true`` when the value is present and >= 0; ``false`` (never NULL) otherwise.

    NaN passes (Spark orders NaN above every number)."""
    c = F.col(name)
    return c.isNotNull() & (c >= 0)


def all_true(names) -> Column:
    """AND of boolean columns."""
    return reduce(lambda a, b: a & b, [F.col(n) for n in names])
