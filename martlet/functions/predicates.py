"""Predicate helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(conditions: list[Column]) -> Column:
    """C15 ``WHERE TRUE AND ...``: fold optional conditions; none -> TRUE."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    """C6 disjunction of conditions; none -> FALSE."""
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
