"""Parquet sinks with the layouts the models declare.

A layout is applied as DataFrame operations just before the writer:

* partitioning (A4-A8) becomes a Hive-style ``partitionBy`` column derived
  from the data (day of a timestamp, a date, first day of month, integer
  range bucket, string value), so later reads prune whole directories;
* clustering (A9) and key distribution + sort (A10) become a range
  repartition on the clustering columns followed by a sort inside each task:
  files hold narrow key ranges, Parquet min/max statistics skip row groups,
  and a hot key is split across several tasks instead of one;
* clustering on several columns alike sorts by an interleaved key instead
  (``martlet.operators.clustering``);
* even distribution + compound sort (A11) is a rebalanced repartition and a
  sort inside each task.

Full refreshes (A3) write a new version directory; the version is committed
when Spark's job commit writes ``_SUCCESS`` there. Readers take the newest
committed version, so a failed or half-written refresh is never read.
Partition-level replacement (used by the incremental layer) uses dynamic
partition overwrite.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions.dates import month_start
from martlet.operators.clustering import with_curve_key
from martlet.session import shuffle_partitions


@dataclass(frozen=True)
class Layout:
    """Physical layout of a materialised model.

    partition_field / partition_kind: ``day`` (timestamp -> day),
    ``date`` (a DATE column), ``month`` (date/timestamp -> first day of month),
    ``range`` (integer bucket of width ``range_interval`` in
    [range_start, range_end)), ``value`` (the column itself, e.g. a string).
    """
    partition_field: str | None = None
    partition_kind: str | None = None
    range_start: int = 0
    range_end: int | None = 100_000_000     # None: no end, and so no partition of all that lies beyond
    range_interval: int = 10_000
    cluster_by: tuple[str, ...] = ()
    curve: bool = False                # cluster on all columns alike (interleaved key) instead of one after the other
    distribute_by: str | None = None
    sort_by: tuple[str, ...] = ()
    even: bool = False
    num_parts: int | None = None

    @property
    def partition_column(self) -> str | None:
        if not self.partition_field:
            return None
        if self.partition_kind in ("date", "value"):
            return self.partition_field
        return f"{self.partition_field}_{self.partition_kind}"


def partition_value(layout: Layout) -> Column | None:
    """The partition column expression of ``layout``."""
    f, kind = layout.partition_field, layout.partition_kind
    if not f:
        return None
    c = F.col(f)
    if kind == "day":
        return F.to_date(c)
    if kind == "date":
        return c
    if kind == "month":
        return month_start(c)
    if kind == "range":
        in_range = (c >= layout.range_start) if layout.range_end is None else (c >= layout.range_start) & (c < layout.range_end)
        bucket = F.floor((c - layout.range_start) / layout.range_interval) * layout.range_interval \
            + layout.range_start
        return F.when(in_range, bucket.cast("long"))
    if kind == "value":
        return c
    raise ValueError(f"unknown partition kind {kind}")


def with_partition_column(df: DataFrame, layout: Layout) -> DataFrame:
    col = layout.partition_column
    if col is None or col in df.columns and layout.partition_kind in ("date", "value"):
        return df
    return df.withColumn(col, partition_value(layout))


def _spread(df: DataFrame) -> Column:
    """Deterministic tie-breaker for range keys: a value that holds a large share
    of the rows (one hot day, one hot customer) still spreads over several
    tasks, and a retried task sees the same split."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def parts_for(df: DataFrame, partitioned: bool) -> list[int]:
    """Number of tasks that write ``df``, as arguments of a repartition.

    The bytes of all inputs (file sizes from the plan; unknown ones count nothing) over the advisory partition size, where that
    is more than the session's shuffle partitions. Otherwise those for a partitioned table, whose many
    folders want tasks; for any other table no number, so neighbouring ranges are joined once their sizes are known.
    """
    spark = df.sparkSession
    advisory = spark._jsparkSession.sessionState().conf().getConfString("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    part_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(advisory)
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        size = int(str(leaves.next().stats().sizeInBytes()))
        total += size if size < (1 << 62) else 0
    wanted, session = -(-total // part_bytes), shuffle_partitions(spark)
    return [wanted] if wanted > session else [session] if partitioned else []


def arrange(df: DataFrame, layout: Layout) -> DataFrame:
    """Apply distribution and in-task sort of ``layout``.

    Range keys start with the partition column, so each task writes a
    contiguous run of partitions (about one file per partition and task
    instead of one per partition per input split). Without ``num_parts`` the
    task count follows the data (``parts_for``).
    """
    n = [layout.num_parts] if layout.num_parts else parts_for(df, bool(layout.partition_column))
    part = [layout.partition_column] if layout.partition_column else []
    if layout.curve and len(layout.cluster_by) > 1:
        keys = part + ["_curve"]
        keyed = with_curve_key(df, list(layout.cluster_by))
        return (keyed.repartitionByRange(*n, *keys, _spread(df)).sortWithinPartitions(*keys, *layout.cluster_by)
                .drop("_curve"))
    if layout.cluster_by:
        keys = part + list(layout.cluster_by)
    elif layout.distribute_by:
        keys = part + [layout.distribute_by] + list(layout.sort_by)
    elif layout.even:
        spread = df.repartition(*n) if n else df.hint("rebalance")
        return spread.sortWithinPartitions(*(part + list(layout.sort_by)))
    elif part:
        keys = part
    else:
        return df
    range_keys = [F.col(k) for k in keys] + [_spread(df)]
    return df.repartitionByRange(*n, *range_keys).sortWithinPartitions(*keys)


def choose_layout(df: DataFrame, if_column: str, layout: Layout, otherwise: Layout | None = None) -> Layout:
    """Pick a layout by the output schema (``... if 'c' in columns else none``)."""
    return layout if if_column in df.columns else (otherwise or Layout())


def switched_layout(variables: dict, *choices: tuple[str, bool, dict]) -> Layout:
    """A layout put together from the run's variables: the fields of each (variable, default, fields) that is on."""
    on = [fields for name, default, fields in choices if variables.get(name, default)]
    return Layout(**{k: v for fields in on for k, v in fields.items()})


def write_parquet(df: DataFrame, path: str, layout: Layout = Layout(), mode: str = "overwrite") -> None:
    out = arrange(with_partition_column(df, layout), layout)
    # Static mode: a full write replaces everything and leaves the _SUCCESS
    # commit marker that readers look for.
    w = out.write.mode(mode).option("partitionOverwriteMode", "static")
    if layout.partition_column:
        w = w.partitionBy(layout.partition_column)
    w.parquet(path)


# ------------------------------------------------------------------ versions
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def partition_dir_value(value) -> str:
    """Directory name part of a Hive-style partition value."""
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    return str(value)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the Hive-style partition directories ``column=value`` directly
    under ``path`` (as text; the default partition of NULLs is left out)."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    prefix = f"{column}="
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            value = name[len(prefix):]
            if value != "__HIVE_DEFAULT_PARTITION__":
                out.append(value)
    return out


def has_data_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds at least one Parquet file (at any depth)."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if name.endswith(".parquet"):
            return True
    return False


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("version-"):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name.split("-", 1)[1]))
    return sorted(out)


def version_path(root: str, v: int) -> str:
    return f"{root.rstrip('/')}/version-{v:06d}"


def current_version_path(spark: SparkSession, root: str) -> str | None:
    vs = committed_versions(spark, root)
    return version_path(root, vs[-1]) if vs else None


def full_refresh(df: DataFrame, root: str, layout: Layout = Layout(), retain: int = 2) -> str:
    """A3: materialise ``df`` as the next version of the table at ``root``.

    After the commit, versions older than the newest ``retain`` are removed
    (the previous one stays for readers that started before the commit).
    """
    spark = df.sparkSession
    vs = committed_versions(spark, root)
    path = version_path(root, (vs[-1] + 1) if vs else 1)
    write_parquet(df, path, layout, mode="overwrite")
    for old in committed_versions(spark, root)[:-retain]:
        delete_path(spark, version_path(root, old))
    return path


def read_table(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """Newest committed version of the table at ``root``.

    A partitioned write of zero rows leaves no files, only the commit marker;
    such a version reads as an empty DataFrame of ``schema`` when given.
    """
    path = current_version_path(spark, root)
    if path is None:
        raise FileNotFoundError(f"no committed version under {root}")
    if schema is not None and not has_data_files(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)
