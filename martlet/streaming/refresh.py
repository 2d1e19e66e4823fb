"""Incremental refresh driven by Structured Streaming.

The batch jobs find new rows with a high-water mark read from the target
(B2). When the source is a folder that only receives new files, the
stream's own checkpoint can play that role instead: a file source with
``trigger(availableNow=True)`` processes exactly the files not seen before,
and ``foreachBatch`` hands each micro-batch to the same ``Target.apply``
used by the batch jobs (merge, delete+insert, insert_overwrite or append).

``merge`` and ``insert_overwrite`` are idempotent per micro-batch, so a batch
replayed after a failure (foreachBatch is at-least-once) leaves the same
target; ``append`` is not and should only be used with a sink that can
de-duplicate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from martlet.sources.target import Target

Transform = Callable[[DataFrame], DataFrame]


def start_refresh(spark: SparkSession, source_path: str, schema: StructType, target: Target,
                  transform: Transform, checkpoint: str, max_files_per_trigger: int | None = None
                  ) -> StreamingQuery:
    """Start a run that applies every not-yet-seen source file, then stops."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_path)

    def apply_batch(batch: DataFrame, epoch_id: int) -> None:
        target.apply(transform(batch))

    return (stream.writeStream.foreachBatch(apply_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def run_refresh(spark: SparkSession, source_path: str, schema: StructType, target: Target,
                transform: Transform, checkpoint: str) -> None:
    """``start_refresh`` and wait for it to finish."""
    q = start_refresh(spark, source_path, schema, target, transform, checkpoint)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
