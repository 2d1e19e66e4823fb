"""Late changes of a dimension, carried into the stored rows that hold its columns.

An increment by high-water mark never looks at old orders again, so a customer renamed later keeps the old name
there. Here the dimension of the last run is kept as a table of row hashes; what differs now
decides which stored rows are rewritten, and ``Target`` rewrites the partitions of just these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.sources.sinks import committed_versions, full_refresh, read_table
from martlet.sources.target import Target


def row_hashes(dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    told = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    return dim.select(F.col(key), told.alias("row_hash"))


def changed_keys(dim: DataFrame, snapshot: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys that are new, gone or have another value in one of ``columns`` since the snapshot."""
    now = row_hashes(dim, key, columns).where(F.col(key).isNotNull())
    then = snapshot.select(F.col(key), F.col("row_hash").alias("old_hash"))
    return now.join(then, key, "full").where(~F.col("row_hash").eqNullSafe(F.col("old_hash"))).select(key).distinct()


def propagate(target: Target, dim: DataFrame, snapshot_root: str, key: str, take: dict[str, str]) -> list:
    """Bring the ``take`` columns (dimension column -> stored column) of all stored rows up to date.

    Returns the partition values rewritten: those whose rows hold a changed key. The first run only stores the snapshot. The
    new snapshot is stored after the target: a run that stops between is simply repeated.
    """
    spark, columns = dim.sparkSession, sorted(take)
    rewritten = []
    if committed_versions(spark, snapshot_root):
        changed = changed_keys(dim, read_table(spark, snapshot_root, f"{key} {dim.schema[key].dataType.simpleString()}, row_hash string"), key, columns)
        stored = target.read()
        if stored is not None:
            pcol = target.config.layout.partition_column
            hit = stored.join(changed, key, "left_semi")
            new = dim.select(F.col(key).alias("_new_key"), *[F.col(c).alias(f"_new_{a}") for c, a in take.items()])
            new = new.join(changed.select(F.col(key).alias("_new_key")), "_new_key", "left_semi")
            batch = hit.join(new, F.col(key) == F.col("_new_key"), "left").withColumns({a: F.col(f"_new_{a}") for a in take.values()}).select(*stored.columns)
            rewritten = sorted(r[0] for r in hit.select(pcol).distinct().collect())
            if rewritten:
                target.apply(batch)
    full_refresh(row_hashes(dim, key, columns).where(F.col(key).isNotNull()), snapshot_root)
    return rewritten
