"""Incrementally maintained Parquet targets.

A target is a partitioned Parquet dataset with versions. Every refresh writes new folders
below ``data/write=<id>`` and then commits a version: a small table that lists the folders (or single files)
that make up the target, each with the schema its rows were written with. Readers
take the newest version that Spark committed with ``_SUCCESS``. No job ever overwrites or deletes what
a reader can see, so one that dies leaves the target as it was, and is simply run again.

* ``merge`` / ``delete+insert`` - partitions holding batch rows or existing rows with a batch key are written again as
  (existing minus batch keys) plus batch; with ``rewrite_files`` only the files that hold a batch key are;
* ``insert_overwrite`` - every partition present in the batch is replaced by the batch's rows for it;
* ``append`` - batch rows are added.

What is untouched is carried over by name. The batch itself is materialised once in the shared folder
before several jobs use it. One writer at a time is assumed.
"""

from __future__ import annotations

import functools
import json
import urllib.parse
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators.incremental import align_schema, dedupe_latest, high_water_mark, merge_rows, project
from martlet.session import scratch_path
from martlet.sources.footers import stored_max
from martlet.sources.sinks import (
    Layout, _fs, arrange, committed_versions, delete_path, partition_dir_value, version_path, with_partition_column)

_PARTITION_TYPES = {"day": T.DateType(), "month": T.DateType(), "date": T.DateType(), "range": T.LongType()}
_NONE = partition_dir_value(None)
_VERSION = "folder string, partition string, files array<string>, schema string"
#: Keys of a batch up to which they are looked up as a list, which Parquet's Bloom filters answer.
LISTED_KEYS = 1000


@dataclass(frozen=True)
class IncrementalConfig:
    layout: Layout
    unique_key: tuple[str, ...] = ()
    strategy: str = "merge"             # merge | delete+insert | insert_overwrite | append
    on_schema_change: str = "ignore"    # ignore | fail | append_new_columns | sync_all_columns
    dedupe_by: tuple[str, ...] = ()     # B17: keep the latest row per key inside a batch
    # False when a key can never change partition (e.g. an order's creation
    # day): merges then only read the batch's partitions of the target instead
    # of looking for its keys everywhere.
    keys_move_partitions: bool = True
    # Merges replace the files that hold a batch key instead of whole partitions. Files are
    # written with Bloom filters on the key, so a small batch is looked up without reading all keys.
    rewrite_files: bool = False
    retain: int = 2                     # versions kept for readers that began before the last commit


@dataclass(frozen=True)
class Entry:
    """A folder of the target, or some files of it, and the schema of its rows."""
    folder: str
    partition: str
    files: tuple[str, ...] | None
    schema: str


class Target:
    def __init__(self, spark: SparkSession, path: str, config: IncrementalConfig):
        if not config.layout.partition_column:
            raise ValueError("incremental targets are partitioned; give the layout a partition field")
        self.spark = spark
        self.path = path.rstrip("/")
        self.config = config

    # -- versions ---------------------------------------------------------
    def _version(self, v: int) -> tuple[list[Entry], str]:
        """(entries, schema) of a committed version: metadata, one row a partition folder."""
        rows = self.spark.read.schema(_VERSION).parquet(version_path(self.path, v)).collect()
        entries = [Entry(r.folder, r.partition, tuple(r.files) if r.files is not None else None, r.schema) for r in rows if r.folder]
        return entries, next(r.schema for r in rows if not r.folder)

    def _current(self) -> tuple[list[Entry], T.StructType] | None:
        versions = committed_versions(self.spark, self.path)
        if not versions:
            return None
        entries, schema = self._version(versions[-1])
        return entries, T.StructType.fromJson(json.loads(schema))

    def _commit(self, entries: list[Entry], schema: T.StructType) -> None:
        versions = committed_versions(self.spark, self.path)
        rows = [(None, None, None, schema.json()), *[(e.folder, e.partition, list(e.files) if e.files is not None else None, e.schema) for e in entries]]
        new = version_path(self.path, versions[-1] + 1 if versions else 1)
        self.spark.createDataFrame(rows, _VERSION).coalesce(1).write.mode("overwrite").parquet(new)
        self._vacuum()

    def _vacuum(self) -> None:
        """Delete versions beyond the retained ones, and data that no retained version names."""
        versions = committed_versions(self.spark, self.path)
        named = {e.folder.split("/")[0] for v in versions[-self.config.retain:] for e in self._version(v)[0]}
        for v in versions[:-self.config.retain]:
            delete_path(self.spark, version_path(self.path, v))
        for folder in self._children("data"):
            if folder not in named:
                delete_path(self.spark, f"{self.path}/data/{folder}")

    def _children(self, folder: str) -> list[str]:
        fs, p, _ = _fs(self.spark, f"{self.path}/{folder}")
        if not fs.exists(p):
            return []
        return [st.getPath().getName() for st in fs.listStatus(p) if not st.getPath().getName().startswith(("_", "."))]

    def _write(self, rows: DataFrame) -> list[Entry]:
        """Write rows to folders of their own."""
        lay, pcol = self.config.layout, self.config.layout.partition_column
        folder, writer = f"write={uuid.uuid4().hex}", arrange(rows, lay).write
        if self.config.rewrite_files:
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
            for k in self.config.unique_key:
                writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
        writer.partitionBy(pcol).parquet(f"{self.path}/data/{folder}")
        schema = rows.schema.json()
        return [Entry(f"{folder}/{name}", urllib.parse.unquote(name.split("=", 1)[1]), None, schema) for name in self._children(f"data/{folder}")]

    # -- state ------------------------------------------------------------
    def exists(self) -> bool:
        return bool(committed_versions(self.spark, self.path))

    def _paths(self, entries: list[Entry]) -> list[str]:
        out = []
        for e in entries:
            out += [f"{self.path}/data/{e.folder}"] if e.files is None else [f"{self.path}/data/{e.folder}/{f}" for f in e.files]
        return out

    def _read(self, entries: list[Entry], schema: T.StructType, located: bool = False) -> DataFrame:
        """Rows of the entries under ``schema``: rows written with another one are projected onto it."""
        parts = []
        for stored in sorted({e.schema for e in entries}):
            some = [e for e in entries if e.schema == stored]
            df = (self.spark.read.schema(T.StructType.fromJson(json.loads(stored))).option("basePath", f"{self.path}/data")
                  .parquet(*self._paths(some)))
            at = [F.col("_metadata.file_path").alias("_file")] if located else []
            parts.append(project(df, schema, at))
        return functools.reduce(DataFrame.unionByName, parts)

    def read(self) -> DataFrame | None:
        """The target's rows, or None before the first load (B1) and while it
        holds no rows at all. Columns are those of the last refresh: new ones are NULL in older rows, dropped
        ones are gone for good (B18)."""
        current = self._current()
        if current is None or not current[0]:
            return None
        return self._read(*current)

    def mark(self, column: str, default=None):
        """B2/B4 high-water mark ``max(column)`` of the target.

        When the target is partitioned by ``column`` itself, or by its day or
        month, the maximum lies in the newest partition: the version
        (metadata) picks it and only that partition is read. Otherwise the
        maximum comes from the files' footers, or from the column where those
        don't have it.
        """
        lay = self.config.layout
        current = self._current()
        if current is None or not current[0]:
            return default
        entries, schema = current
        monotone = lay.partition_field == column and lay.partition_kind in ("day", "month", "date")   # a range layout has an overflow partition too
        values = [e.partition for e in entries if e.partition != _NONE] if monotone else []
        if values:
            entries = [e for e in entries if e.partition == max(values)]
        rows = self._read(entries, schema)
        if values or column == lay.partition_column or len({e.schema for e in entries}) > 1:
            return high_water_mark(rows, column, default)
        mark = stored_max(self.spark, self._paths(entries), column, rows, f"{self.path}/data")
        return default if mark is None else mark

    def is_incremental(self, full_refresh: bool = False) -> bool:
        """B1: ``is_incremental()`` - the target exists and no full refresh is asked."""
        return self.exists() and not full_refresh

    # -- refreshes --------------------------------------------------------
    def _typed(self, rows: DataFrame) -> DataFrame:
        """Rows with their partition column, in the type it is read back with."""
        lay = self.config.layout
        rows = with_partition_column(rows, lay)
        kind = _PARTITION_TYPES.get(lay.partition_kind)
        return rows if kind is None else rows.withColumn(lay.partition_column, F.col(lay.partition_column).cast(kind))

    def load_full(self, rows: DataFrame) -> None:
        """First load / full refresh: a version of nothing but these rows."""
        rows = self._typed(rows)
        self._commit(self._write(rows), rows.schema)

    def apply(self, batch: DataFrame) -> None:
        """Apply one batch with the configured strategy."""
        cfg = self.config
        if cfg.strategy not in ("append", "merge", "delete+insert", "insert_overwrite"):
            raise ValueError(f"unknown strategy {cfg.strategy}")
        batch = self._typed(batch)
        if cfg.dedupe_by:
            batch = dedupe_latest(batch, list(cfg.unique_key), list(cfg.dedupe_by))
        current = self._current()
        if current is None or not current[0]:   # no target yet, or one without rows
            self.load_full(batch)
            return
        entries, stored = current
        existing, batch = align_schema(self._read(entries, stored), batch, cfg.on_schema_change)
        schema = existing.schema
        entries = [self._without(e, schema) for e in entries]

        if cfg.strategy == "append":
            self._commit(entries + self._write(batch), schema)   # one job reads the batch once
            return
        # The batch is read by several jobs below. Materialise it once so they
        # all see the same rows even if the source changes meanwhile.
        batch_path = scratch_path(self.spark, "batch")
        batch.write.mode("overwrite").parquet(batch_path)
        try:
            self._replace(self.spark.read.schema(batch.schema).parquet(batch_path), entries, schema)
        finally:
            delete_path(self.spark, batch_path)

    def _without(self, e: Entry, schema: T.StructType) -> Entry:
        """The entry without columns that the target no longer has: should they come back, old values don't."""
        fields = T.StructType.fromJson(json.loads(e.schema)).fields
        kept = [f for f in fields if f.name in schema.names]
        return e if len(kept) == len(fields) else replace(e, schema=T.StructType(kept).json())

    def _replace(self, batch: DataFrame, entries: list[Entry], schema: T.StructType) -> None:
        cfg, pcol = self.config, self.config.layout.partition_column
        if cfg.strategy == "insert_overwrite":
            new = self._write(batch)
            replaced = {e.partition for e in new}
            self._commit([e for e in entries if e.partition not in replaced] + new, schema)
            return
        keys = list(cfg.unique_key)
        if cfg.strategy == "merge":     # merge keeps one row a key; delete+insert keeps every batch row
            twice = batch.groupBy(*keys).count().where("count > 1").head(1)
            if twice:
                raise ValueError(f"merge batch has several rows for one key, e.g. {twice[0]}; give dedupe_by")
        # Partition values and file names are all that reaches the driver below.
        own = {partition_dir_value(r[0]) for r in batch.select(pcol).distinct().collect()}
        looked = entries if cfg.keys_move_partitions else [e for e in entries if e.partition in own]
        if cfg.rewrite_files:
            hit = self._files_with_keys(looked, schema, batch, keys)
            kept, old = self._split(entries, hit)
        else:
            touched = set(own)
            if cfg.keys_move_partitions:
                found = self._with_keys(self._read(looked, schema), batch, keys).select(pcol).distinct().collect()
                touched |= {partition_dir_value(r[0]) for r in found}
            kept = [e for e in entries if e.partition not in touched]
            old = [e for e in entries if e.partition in touched]
        rows = merge_rows(self._read(old, schema), batch, keys) if old else batch
        self._commit(kept + self._write(rows), schema)

    def _with_keys(self, rows: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
        """Rows whose key is in the batch. Few single keys go down to the scan as a list."""
        wanted = batch.select(*keys).distinct()
        if len(keys) == 1:
            few = [r[0] for r in wanted.limit(LISTED_KEYS + 1).collect()]
            if len(few) <= LISTED_KEYS and None not in few:
                return rows.where(F.col(keys[0]).isin(few) if few else F.lit(False))
        return rows.join(wanted, keys, "left_semi")

    def _files_with_keys(self, entries: list[Entry], schema: T.StructType, batch: DataFrame, keys: list[str]) -> dict[str, set[str]]:
        """folder -> files that hold a key of the batch."""
        out: dict[str, set[str]] = {}
        if entries:
            found = self._with_keys(self._read(entries, schema, located=True), batch, keys).select("_file").distinct().collect()
            for (uri,) in found:
                folder, name = urllib.parse.unquote(uri).rsplit("/data/", 1)[1].rsplit("/", 1)
                out.setdefault(folder, set()).add(name)
        return out

    def _split(self, entries: list[Entry], hit: dict[str, set[str]]) -> tuple[list[Entry], list[Entry]]:
        """Entries without the files that were hit, and these files."""
        hit = {urllib.parse.unquote(k): v for k, v in hit.items()}
        kept, old = [], []
        for e in entries:
            names = hit.get(urllib.parse.unquote(e.folder))
            if not names:
                kept.append(e)
                continue
            rest = set(e.files if e.files is not None else [f for f in self._children(f"data/{e.folder}") if f.endswith(".parquet")]) - names
            if rest:
                kept.append(replace(e, files=tuple(sorted(rest))))
            old.append(replace(e, files=tuple(sorted(names))))
        return kept, old
