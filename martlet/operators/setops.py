"""Set operations and unpivots (H1-H4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_distinct(frames: list[DataFrame]) -> DataFrame:
    """H1 ``UNION``: union by name, then de-duplicate (one shuffle)."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def union_all(frames: list[DataFrame]) -> DataFrame:
    """H2 ``UNION ALL``: no shuffle at all."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def unpivot_measures(df: DataFrame, ids: list[str], measures: dict[str, str],
                     value_name: str, label_name: str) -> DataFrame:
    """H3: turn measure columns into (label, value) rows in one pass.

    ``measures`` maps column -> label. Uses ``stack`` so the input is read once
    (the two-scan UNION form reads it once per label).
    """
    parts = []
    for col, label in measures.items():
        parts += [f"'{label}'", f"`{col}`"]
    expr = f"stack({len(measures)}, {', '.join(parts)}) as (`{label_name}`, `{value_name}`)"
    return df.selectExpr(*[f"`{i}`" for i in ids], expr)


def unpivot_structs(df: DataFrame, ids: list[str], measures: dict[str, str],
                    value_name: str, label_name: str) -> DataFrame:
    """H4 ``UNNEST([STRUCT(v1,'a'), STRUCT(v2,'b')])``: inline an array of structs."""
    arr = F.array(*[F.struct(F.col(c).alias(value_name), F.lit(label).alias(label_name))
                    for c, label in measures.items()])
    return df.select(*ids, F.inline(arr))
