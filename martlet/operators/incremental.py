"""Incremental refresh algebra (B2-B14, B17-B19) on DataFrames.

Marks are single values: one aggregate row crosses to the driver and comes
back as a literal, so the filter on the source reaches the Parquet scan and
prunes partitions. Upserts are set algebra (anti-join + union) because
Parquet has no MERGE; they only ever touch the rows of the partitions being
replaced (see ``martlet.sources.target``).
"""

from __future__ import annotations

import datetime as dt
import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaChangeError(ValueError):
    """The batch schema differs from the target and the model says fail."""


def high_water_mark(target: DataFrame | None, col: str, default=None):
    """``max(col)`` of the target (``default`` when it is empty or absent)."""
    if target is None:
        return default
    v = target.agg(F.max(col).alias("m")).first()["m"]
    return default if v is None else v


def per_key_marks(target: DataFrame, keys: list[str], col: str, name: str = "_mark") -> DataFrame:
    """One mark per key (partial aggregation, one row per key)."""
    return target.groupBy(*keys).agg(F.max(col).alias(name))


def after_per_key_mark(batch: DataFrame, marks: DataFrame, keys: list[str], col: str,
                       name: str = "_mark") -> DataFrame:
    """Keep rows newer than their key's mark, or whose key has no mark."""
    named = marks.select(*[F.col(k).alias(f"_mark_{k}") for k in keys], name)
    same = [F.col(k).eqNullSafe(F.col(f"_mark_{k}")) for k in keys]      # a NULL key has a mark of its own
    return (batch.join(named, functools.reduce(operator.and_, same), "left")
                 .where(F.col(name).isNull() | (F.col(col) > F.col(name)))
                 .select(*batch.columns))


def mark_condition(col: str, mark, inclusive: bool = False, lookback_days: int = 0,
                   lookback_months: int = 0) -> Column:
    """``col > mark`` / ``col >= mark``, or ``col >= mark - look-back``
    (days or months) to pick up late rows. A missing mark compares with NULL
    and selects nothing, as SQL does; give ``high_water_mark`` a default for
    the null-safe form (B4)."""
    c = F.col(col)
    if mark is None:
        return c > F.lit(None)
    if lookback_days or lookback_months:
        start = F.to_date(F.lit(mark))
        if lookback_months:
            start = F.add_months(start, -lookback_months)
        if lookback_days:
            start = F.date_sub(start, lookback_days)
        return c >= start
    return c >= F.lit(mark) if inclusive else c > F.lit(mark)


def rolling_window_start(as_of: dt.date, first_load: bool, first_days: int, later_days: int) -> Column:
    """Window start, longer on the first load."""
    return F.date_sub(F.lit(as_of), first_days if first_load else later_days)


def dedupe_latest(batch: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key, the one with the greatest ``order_by`` (then the
    greatest remaining columns, so the pick is deterministic).

    An aggregate with ``max_by`` instead of ``row_number`` over a window: the
    partial aggregate collapses a hot key before the shuffle.
    """
    rest = [c for c in batch.columns if c not in keys]
    tie = [c for c in rest if c not in order_by]
    order = F.struct(*[F.col(c) for c in order_by + tie])
    picked = batch.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*batch.columns)


def merge_rows(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """B12/B13 merge: existing rows whose key is in the batch are replaced."""
    return existing.join(batch.select(*keys).distinct(), keys, "left_anti").unionByName(batch)


def align_schema(existing: DataFrame, batch: DataFrame, on_schema_change: str) -> tuple[DataFrame, DataFrame]:
    """Reconcile the target with a batch whose columns changed.

    ignore            - batch projected onto the target's columns
    fail              - raise SchemaChangeError on any difference
    append_new_columns- union of columns (missing ones NULL)
    sync_all_columns  - the batch's columns win: new ones added (NULL in old
                        rows), dropped ones removed; a wider type is taken over, any
                        other change of type raises
    """
    e_fields = {f.name: f.dataType for f in existing.schema.fields}
    b_fields = {f.name: f.dataType for f in batch.schema.fields}
    if e_fields == b_fields:
        return existing, batch
    if on_schema_change == "fail":
        raise SchemaChangeError(f"schema changed: target={existing.schema.simpleString()} "
                                f"batch={batch.schema.simpleString()}")
    if on_schema_change == "ignore":
        return existing, project(batch, existing.schema)
    if on_schema_change == "append_new_columns":
        fields = list(existing.schema.fields) + [f for f in batch.schema.fields if f.name not in e_fields]
        schema = T.StructType(fields)
        return project(existing, schema), project(batch, schema)
    if on_schema_change == "sync_all_columns":
        narrower = {n: (e_fields[n], t) for n, t in b_fields.items() if n in e_fields and not widens(e_fields[n], t)}
        if narrower:
            raise SchemaChangeError(f"stored values don't fit the new types: {narrower}")
        return project(existing, batch.schema), batch
    raise ValueError(f"unknown on_schema_change {on_schema_change}")


_WIDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` has a value in ``new``: the same type, a larger number, a time for a date, text for anything simple."""
    if old == new:
        return True
    if type(old) in _WIDER and type(new) in _WIDER:
        return _WIDER.index(type(old)) < _WIDER.index(type(new)) and not (isinstance(old, (T.IntegerType, T.LongType)) and isinstance(new, T.FloatType)) \
            and not (isinstance(old, T.LongType) and isinstance(new, T.DoubleType))
    if isinstance(old, T.DateType):
        return isinstance(new, (T.TimestampType, T.TimestampNTZType, T.StringType))
    return isinstance(new, T.StringType) and isinstance(old, T.AtomicType) and not isinstance(old, T.BinaryType)


def project(df: DataFrame, schema: T.StructType, more: list[Column] | None = None) -> DataFrame:
    """``df`` under another schema: columns it lacks are NULL, others are cast; then ``more`` columns."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields], *(more or []))
