"""Maxima of stored columns from Parquet footers (E4, D9, F3, and the marks of B2).

A high-water mark needs one number of a table that may be huge, and every Parquet footer holds the maximum of
each row group. Spark's Parquet scan can answer ``max`` from there (aggregate push-down of the V2 source): no row
group is read. That source is chosen in a session of its own, so the caller's settings stay as they are.

Spark doesn't push maxima of times. Those it stores as microseconds, so they are asked for as whole numbers.

An answer counts only if some row has that value and none has a greater one. Both are filters that Parquet statistics
answer without reading other row groups, and they guard against files with other column orders, or times
in another unit. Where footers have no answer (no statistics, texts, only nulls) the column is read.
"""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PUSHED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session on the same context whose Parquet scans answer aggregates from footers."""
    out = spark.newSession()
    out.conf.set("spark.sql.session.timeZone", "UTC")
    v1 = [s for s in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if s.strip() != "parquet"]
    out.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    out.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return out


def footer_max(spark: SparkSession, paths: list[str], column: str, base: str | None = None) -> DataFrame:
    """One row with the greatest value as footers tell it; times as microseconds."""
    def reader(session):
        return session.read.option("basePath", base) if base else session.read
    fields = [T.StructField(f.name, T.LongType()) if f.name == column and isinstance(f.dataType, T.TimestampNTZType) else f
              for f in reader(spark).parquet(*paths).schema.fields]
    return reader(footer_session(spark)).schema(T.StructType(fields)).parquet(*paths).agg(F.max(column).alias("m"))


def stored_max(spark: SparkSession, paths: str | list[str], column: str, df: DataFrame | None = None, base: str | None = None):
    """Greatest value of a column of the Parquet table at ``paths``, None where there is none.

    ``df`` is the table as its reader sees it, where that differs from a plain read; it is what is read if the
    footers don't help. ``base`` is the folder below which partition folders are named.
    """
    paths = [paths] if isinstance(paths, str) else paths
    table = spark.read.parquet(*paths) if df is None else df
    dtype = table.schema[column].dataType
    if isinstance(dtype, (*_PUSHED, T.TimestampNTZType)):
        try:
            value = footer_max(spark, paths, column, base).first()["m"]
        except (PySparkException, Py4JError):
            value = None                     # no statistics for this column in some file
        if value is not None:
            if isinstance(dtype, T.TimestampNTZType):
                value = spark.range(1).select(F.timestamp_micros(F.lit(value)).cast("timestamp_ntz").alias("t")).first()["t"]
            rows, told = table.select(column), F.lit(value).cast(dtype)
            if rows.where(F.col(column) == told).head(1) and not rows.where(F.col(column) > told).head(1):
                return value
    return table.agg(F.max(column).alias("m")).first()["m"]
