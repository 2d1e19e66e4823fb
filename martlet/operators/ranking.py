"""RANK() OVER (PARTITION BY keys ORDER BY value) without one task per key (F1, F2).

A window partitioned by month puts every row of a month into one task; with
billions of (month, product) rows that is one straggler per month and 80-way
parallelism at most. Here the ranking runs as a range-partitioned scan:

1. range-partition on (keys, value, row hash) into ``n`` parts and sort inside
   each part, so a large key group - and even a large group of tied values -
   is spread over many parts;
2. rank inside each part with a window over (part, keys);
3. a part can only *continue* the key group (and the tie run) that ended the
   previous part, so one summary row per part (first/last key and value, rows
   of the last key and of the last tie run) is enough to compute every part's
   offset: earlier rows of the same key count, earlier rows tied with the
   part's first value do not. The summary has exactly ``n`` rows - a proven
   bound - and is broadcast.

The locally ranked parts are written once to the cluster's shared checkpoint
folder because two branches read them and must agree on which row sits in
which part; the copy is deleted when the driver ends (``session.release_scratch``).

The result equals SQL ``RANK()`` (ties share a rank, gaps follow).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.session import scratch_path, shuffle_partitions

_PID = "_mrt_pid"
_LRANK = "_mrt_lrank"


def _offsets(summary: DataFrame, last_col: str, first_col: str, count_col: str) -> DataFrame:
    """Per part p: sum of ``count_col`` over earlier parts q whose ``last_col``
    equals p's ``first_col`` (the runs that continue into p)."""
    events = summary.select(F.inline(F.array(
        F.struct(F.col(last_col).alias("_k"), F.col(_PID).alias("_p"), F.lit(1).alias("_is_run"),
                 F.col(count_col).cast("long").alias("_c")),
        F.struct(F.col(first_col).alias("_k"), F.col(_PID).alias("_p"), F.lit(0).alias("_is_run"),
                 F.lit(0).cast("long").alias("_c")))))
    w = (Window.partitionBy("_k").orderBy(F.col("_p"), F.col("_is_run"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (events.withColumn("_off", F.sum("_c").over(w))
            .where(F.col("_is_run") == 0)
            .select(F.col("_p").alias(_PID), F.col("_off")))


def rank_within(df: DataFrame, keys: list[str], value: str, out: str = "rank",
                descending: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = RANK() OVER (PARTITION BY keys ORDER BY value [DESC])."""
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    val_order: Column = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    sort_cols = [F.col(k).asc_nulls_first() for k in keys] + [val_order]
    # A deterministic row hash as the last range key lets one huge tie group
    # (same key and value) spread over several parts as well.
    spread = F.xxhash64(*[F.col(c) for c in df.columns])

    # Explicit part count (AQE must not coalesce: the part id becomes data).
    parts = (df.repartitionByRange(n, *sort_cols, spread)
               .withColumn(_PID, F.spark_partition_id()))
    inside = Window.partitionBy(_PID, *keys).orderBy(val_order)
    parts = parts.withColumn(_LRANK, F.rank().over(inside).cast("long"))
    # The ranked parts are read twice below (rows and per-part summary). They
    # are written once to the shared checkpoint folder, which pins the part
    # ids (a recomputed range shuffle could draw other bounds) and cuts the
    # lineage; being Parquet, the summary reads only the columns it needs.
    staged = scratch_path(spark, "rank")
    parts.write.mode("overwrite").parquet(staged)
    local = spark.read.parquet(staged)

    key = F.struct(*[F.col(k) for k in keys])
    # Inside a part, tied rows share a local rank equal to the position of the
    # run's first row: the first run of a key has the smallest local rank, the
    # last run the largest, and the last run holds (rows - largest rank + 1)
    # rows. One aggregate per (part, key) therefore gives everything needed.
    per_key = (local.groupBy(_PID, *keys)
               .agg(F.count(F.lit(1)).alias("_n"),
                    F.max(_LRANK).alias("_last_r"),
                    F.min_by(value, _LRANK).alias("_first_v"),
                    F.max_by(value, _LRANK).alias("_last_v"))
               .withColumn("_last_run_n", F.col("_n") - F.col("_last_r") + 1))
    summary = (per_key.groupBy(_PID)
               .agg(F.min(key).alias("_first_k"), F.max(key).alias("_last_k"),
                    F.min_by("_first_v", key).alias("_first_v"),
                    F.max_by("_last_v", key).alias("_last_v"),
                    F.max_by("_n", key).alias("_last_k_n"),
                    F.max_by("_last_run_n", key).alias("_last_kv_n"))
               .withColumn("_first_kv", F.struct(F.col("_first_k").alias("k"), F.col("_first_v").alias("v")))
               .withColumn("_last_kv", F.struct(F.col("_last_k").alias("k"), F.col("_last_v").alias("v"))))
    # One row per part: computed once and kept as a small local table (like the
    # range partitioner's own sample, its size is fixed by the part count), so
    # the three uses below do not re-aggregate the staged parts.
    summary = spark.createDataFrame(summary.collect(), summary.schema)
    # Rows of p's first key in earlier parts are all ranked ahead of p's rows of
    # that key, except the ones tied with p's first value (a run that began
    # earlier): those share the rank of the run's first row.
    off_k = _offsets(summary, "_last_k", "_first_k", "_last_k_n").withColumnRenamed("_off", "_off_k")
    off_kv = _offsets(summary, "_last_kv", "_first_kv", "_last_kv_n").withColumnRenamed("_off", "_off_kv")
    offsets = (summary.select(_PID, "_first_k", "_first_v")
               .join(off_k, _PID, "left").join(off_kv, _PID, "left"))

    # ``offsets`` has exactly one row per part (n rows): safe to broadcast.
    ranked = local.join(F.broadcast(offsets), _PID, "left")
    same_key = key.eqNullSafe(F.col("_first_k"))
    tied = same_key & F.col(value).eqNullSafe(F.col("_first_v"))
    bump = (F.when(same_key, F.coalesce(F.col("_off_k"), F.lit(0))).otherwise(F.lit(0))
            - F.when(tied, F.coalesce(F.col("_off_kv"), F.lit(0))).otherwise(F.lit(0)))
    return (ranked.withColumn(out, (F.col(_LRANK) + bump).cast("long"))
                  .drop(_PID, _LRANK, "_first_k", "_first_v", "_off_k", "_off_kv"))
