"""Aggregation helpers (E1-E18). All are plain ``groupBy().agg()`` so Spark
runs a partial (map-side) aggregate before the shuffle: a key holding a third
of the rows is reduced to one row per task before it moves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_when(cond: Column, value: Column | None = None) -> Column:
    """``COUNT(CASE WHEN cond THEN value END)``; without ``value`` it
    counts rows (``COUNTIF``)."""
    return F.count(F.when(cond, value if value is not None else F.lit(1)))


def sum_when_else_zero(cond: Column, value: Column | None = None) -> Column:
    """E6 ``SUM(CASE WHEN cond THEN v ELSE 0 END)``: 0 when nothing matches."""
    return F.sum(F.when(cond, value if value is not None else F.lit(1)).otherwise(F.lit(0)))


def sum_when_or_null(cond: Column, value: Column | None = None) -> Column:
    """E7 ``SUM(CASE WHEN cond THEN v END)``: NULL when nothing matches."""
    return F.sum(F.when(cond, value if value is not None else F.lit(1)))


def having(agg: DataFrame, cond: Column) -> DataFrame:
    """E8 ``HAVING``: a filter above the aggregate."""
    return agg.where(cond)


def distinct_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """E13/E14 ``SELECT DISTINCT cols`` (= GROUP BY all columns)."""
    return df.select(*cols).distinct()
