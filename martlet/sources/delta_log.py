"""Append-only logs of signed rows: the state behind incrementally maintained aggregates.

A log holds a multiset of rows as changes. Each batch appends rows with a signed multiplicity
``n`` (and signed measures); the state is the sum of all changes per key. Nothing is ever rewritten
in place:

* a batch is one folder (``change=<id>``), committed by Spark's ``_SUCCESS``. A batch id that is committed already
  adds nothing, so a replayed batch is harmless; one that failed half-way is written again;
* ``read(without=id)`` is the state as it was before that batch. What a batch adds is always computed from
  there, so a job that died between two logs is simply run again;
* ``compact`` folds all changes into a new base folder, which counts once the list of the batches it
  covers is committed beside it. Folders that the base before it covered are deleted then, so
  readers of the last state are not disturbed.

A log may be partitioned by a hash bucket of a key or by a day, and is sorted by its keys within, so that
a batch reads the state of the keys it touches and little more.
"""

from __future__ import annotations

import functools
import operator
import urllib.parse
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.sources.sinks import Layout, _fs, delete_path, partition_dir_value, partition_values, path_exists, write_parquet

N = "n"


def bucket_of(column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class LogSpec:
    """Columns of a log. ``n`` is added to the sums; ``latest`` columns keep their maximum and can't be taken back."""
    keys: str                              # DDL of the key columns
    sums: str = ""                         # DDL of summed measures
    latest: str = ""                       # DDL of columns of which the greatest counts
    bucket_by: str | None = None           # key column whose hash bucket is the partition
    buckets: int = 64
    partition: str | None = None           # or: a key column that is itself the partition
    compact_after: int = 16                # committed batches after which appending compacts

    def names(self, ddl: str) -> list[str]:
        return T._parse_datatype_string(ddl).names if ddl else []

    @property
    def partition_column(self) -> str | None:
        return "bucket" if self.bucket_by else self.partition

    @property
    def schema(self) -> T.StructType:
        fields = [f for d in (self.keys, self.sums, f"{N} long", self.latest) if d for f in T._parse_datatype_string(d).fields]
        return T.StructType(fields + ([T.StructField("bucket", T.IntegerType())] if self.bucket_by else []))


class DeltaLog:
    def __init__(self, spark: SparkSession, path: str, spec: LogSpec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec

    # -- folders ----------------------------------------------------------
    def _folders(self, prefix: str, marker: str) -> list[str]:
        fs, p, jvm = _fs(self.spark, self.path)
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        return sorted(x for x in names if x.startswith(prefix) and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{x}/{marker}")))

    def _base(self) -> tuple[str | None, set[str]]:
        """The newest complete base and the folders it covers."""
        lists = self._folders("covered-", "_SUCCESS")
        if not lists:
            return None, set()
        return self._base_folder(lists[-1]), {r[0] for r in self.spark.read.parquet(f"{self.path}/{lists[-1]}").collect()}

    def _batches(self) -> list[str]:
        return self._folders("change=batch-", "_SUCCESS")

    @staticmethod
    def _base_folder(covered: str) -> str:
        return "change=base-" + covered.split("-")[1]

    @staticmethod
    def _folder(batch_id) -> str:
        return "change=batch-" + urllib.parse.quote(str(batch_id), safe="")

    def has(self, batch_id) -> bool:
        folder = self._folder(batch_id)
        return path_exists(self.spark, f"{self.path}/{folder}/_SUCCESS") or folder in self._base()[1]

    # -- rows -------------------------------------------------------------
    def fold(self, rows: DataFrame, keys: list[str] | None = None, keep_zero: bool = False) -> DataFrame:
        """One row a key with the sums of all changes; keys whose multiplicity is zero are gone."""
        s = self.spec
        by = keys or (s.names(s.keys) + (["bucket"] if s.bucket_by else []))
        out = rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in [*s.names(s.sums), N]], *[F.max(c).alias(c) for c in s.names(s.latest)])
        return out if keep_zero else out.where(F.col(N) != 0)

    def read(self, without=None) -> DataFrame:
        """All changes, in the state before batch ``without``."""
        base, covered = self._base()
        skip = covered | ({self._folder(without)} if without is not None else set())
        if without is not None and self._folder(without) in covered:
            raise ValueError(f"batch {without} is part of a compacted state")
        paths = ([f"{self.path}/{base}"] if base else []) + [f"{self.path}/{f}" for f in self._batches() if f not in skip]
        if not paths:
            return self.spark.createDataFrame([], self.spec.schema)
        return self.spark.read.schema(self.spec.schema).option("basePath", self.path).parquet(*paths).select(*self.spec.schema.names)

    def state(self, without=None) -> DataFrame:
        return self.fold(self.read(without))

    def touching(self, keys: DataFrame, on: list[str], without=None) -> DataFrame:
        """State of the rows whose ``on`` columns are in ``keys``.

        Where the log's bucket column is among them, the buckets that occur in ``keys`` (a list no longer than the
        number of buckets) prune the partitions that are read.
        """
        rows, s = self.read(without), self.spec
        if s.bucket_by in on:
            hit = [r[0] for r in keys.select(bucket_of(s.bucket_by, s.buckets)).distinct().collect()]
            rows = rows.where(F.col("bucket").isin(hit) if hit else F.lit(False))
        wanted = keys.select(*[F.col(c).alias(f"_wanted_{c}") for c in on]).distinct()
        same = functools.reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"_wanted_{c}")) for c in on])
        return self.fold(rows.join(wanted, same, "left_semi"))

    # -- changes ----------------------------------------------------------
    def append(self, rows: DataFrame, batch_id) -> bool:
        """Add the changes of a batch; False, and nothing done, where the batch is there already."""
        if self.has(batch_id):
            return False
        self._write(rows, f"{self.path}/{self._folder(batch_id)}")
        if len(self._batches()) >= self.spec.compact_after:
            self.compact()
        return True

    def _write(self, rows: DataFrame, path: str) -> None:
        s = self.spec
        if s.bucket_by:
            rows = rows.withColumn("bucket", bucket_of(s.bucket_by, s.buckets))
        part = s.partition_column
        keys = tuple(k for k in s.names(s.keys) if k != part)
        layout = Layout(partition_field=part, partition_kind="value" if part else None, cluster_by=keys)
        write_parquet(rows.select(*s.schema.names), path, layout)

    def compact(self) -> None:
        """Fold everything into a new base. The state is the same before and after, wherever this stops."""
        base, covered = self._base()
        batches = self._batches()
        new = [f for f in batches if f not in covered]
        if not new:
            return
        number = f"{int(base.rsplit('-', 1)[1]) + 1 if base else 1:06d}"
        self._write(self.state(), f"{self.path}/change=base-{number}")
        told = self.spark.createDataFrame([(f,) for f in sorted(covered | set(new))], "folder string")
        told.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/covered-{number}")
        older = [f for f in self._folders("covered-", "_SUCCESS") if base and self._base_folder(f) < base]
        for old in [f for f in batches if f in covered] + older + [self._base_folder(f) for f in older]:
            delete_path(self.spark, f"{self.path}/{old}")

    def expire(self, before) -> int:
        """Delete the partitions of values under ``before``; how many folders went. Readers must filter by then."""
        gone = 0
        column = self.spec.partition
        base, _ = self._base()
        for root in [base] * bool(base) + self._batches():
            for value in partition_values(self.spark, f"{self.path}/{root}", column):
                if value < partition_dir_value(before):
                    delete_path(self.spark, f"{self.path}/{root}/{column}={value}")
                    gone += 1
        return gone


def negated(rows: DataFrame, spec: LogSpec) -> DataFrame:
    """The same rows taken back."""
    signed = {N, *spec.names(spec.sums)}
    return rows.select(*[(-F.col(c)).alias(c) if c in signed else F.col(c) for c in rows.columns])
