"""Clustering on several columns at once (A9): an interleaved key over quantile ranks.

Sorting by (a, b) lets a reader skip files by a, and by b only within one value of a. Here each column
is mapped to its rank among ``2 ** bits - 1`` quantiles, so that skewed columns use all bits, and the bits of
the ranks are interleaved, most significant first. Files that hold a range of that key are narrow in every
column, so Parquet's min/max statistics skip row groups for a filter on any of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a column's rank; the quantiles are the only thing that reaches the driver (2 ** BITS - 1 values a column).
BITS = 8
#: Characters of a text that count for its rank, and values looked at for each of its quantiles.
TEXT, SAMPLED = 64, 16


def quantiles(df: DataFrame, columns: list[str], bits: int = BITS) -> dict[str, list]:
    """Ascending values that cut each column into about equal parts.

    Numbers, dates and times: one approximate pass over all rows for all columns. Texts: those distinct values with the least
    hashes, a uniform sample of distinct values (a value so frequent that it fills a part by itself needs
    no finer cut).
    """
    parts = 1 << bits
    shares = [i / parts for i in range(1, parts)]
    texts = [c for c in columns if isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType))]
    others = [c for c in columns if c not in texts]
    out = {}
    if others:
        row = df.agg(*[F.percentile_approx(c, shares, parts * SAMPLED).alias(f"q{i}") for i, c in enumerate(others)]).first()
        out |= {c: sorted(set(row[i] or [])) for i, c in enumerate(others)}
    for c in texts:
        short = df.where(F.col(c).isNotNull()).select(F.substring(c, 1, TEXT).alias("v")).distinct()
        found = sorted(r[0] for r in short.orderBy(F.xxhash64("v"), "v").limit(parts * SAMPLED).collect())
        out[c] = sorted({found[len(found) * i // parts] for i in range(1, parts)}) if found else []
    return out


def rank_among(column: str, cuts: list, dtype: T.DataType, bits: int = BITS) -> Column:
    """How many of ``cuts`` are not above the value, by bisection; 0 for a null."""
    if not cuts:
        return F.lit(0)
    value = F.substring(column, 1, TEXT) if isinstance(dtype, (T.StringType, T.BinaryType)) else F.col(column)
    listed = F.array(*[F.lit(x).cast(dtype) for x in cuts])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(listed, at + step - 1) <= value, at + step).otherwise(at))


def interleaved(ranks: list[Column], bits: int = BITS) -> Column:
    """Bits of the ranks in turn, the first column's first."""
    key = F.lit(0).cast("long")
    for b in range(bits):
        for j, r in enumerate(ranks):
            bit = F.shiftright(r, b).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(bit, b * len(ranks) + len(ranks) - 1 - j))
    return key


def with_curve_key(df: DataFrame, columns: list[str], name: str = "_curve", bits: int = BITS) -> DataFrame:
    """``df`` with the interleaved key of ``columns`` (at most 63 bits in all)."""
    bits = min(bits, 63 // len(columns))
    cuts = quantiles(df, columns, bits)
    ranked = df.withColumns({f"{name}_{i}": rank_among(c, cuts[c], df.schema[c].dataType, bits) for i, c in enumerate(columns)})
    keyed = ranked.withColumn(name, interleaved([F.col(f"{name}_{i}") for i in range(len(columns))], bits))
    return keyed.drop(*[f"{name}_{i}" for i in range(len(columns))])
