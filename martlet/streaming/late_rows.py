"""Late and repeated rows by event time (B5, B17): a stateful stream into a ``Target``.

Files may bring rows again and rows of the past. The stream remembers each key for as long as the watermark
(the greatest event time so far less ``delay``) allows, hands every key on once, and forgets it then, so its state is
bounded by the rows of one batch and of twice the ``delay``, whatever the length of the history. Each micro-batch is
merged into the target; a batch replayed after a failure changes nothing.

Spark drops rows that come later than the watermark. None may be lost here: if a run's progress says that
there were any, the source rows older than the watermark whose key the target hasn't got are merged after it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martlet.operators.incremental import dedupe_latest
from martlet.sources.target import Target
from martlet.streaming.refresh import Transform


PROGRESS, ALL_PROGRESS = "spark.sql.streaming.numRecentProgressUpdates", "1000000"


@dataclass
class Run:
    batches: int = 0
    dropped: int = 0          # rows behind the watermark, merged after the stream
    state_rows: int = 0       # most keys remembered at once
    state_left: int = 0       # keys remembered after the last batch


def once_per_key(stream: DataFrame, key: list[str], event_time: str, delay: str) -> DataFrame:
    """Rows of keys not seen within ``delay``; with the event time as ``_event``, which a watermark needs with a zone."""
    return stream.withColumn("_event", F.col(event_time).cast("timestamp")).withWatermark("_event", delay).dropDuplicatesWithinWatermark(key)


def run_late_refresh(spark: SparkSession, source_path: str, schema: StructType, target: Target, transform: Transform, checkpoint: str,
                     event_time: str, delay: str, files_per_batch: int | None = None) -> Run:
    """Apply every file not yet seen, then what came too late for the stream."""
    key = list(target.config.unique_key)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = once_per_key(reader.parquet(source_path), key, event_time, delay)
    kept = spark.conf.get(PROGRESS)
    spark.conf.set(PROGRESS, ALL_PROGRESS)        # the progress of all batches of the run is looked at
    try:
        query = (rows.writeStream.foreachBatch(lambda batch, _: target.apply(transform(batch.drop("_event"))))
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.set(PROGRESS, kept)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()

    run, watermark = Run(), None
    for progress in query.recentProgress:
        run.batches += 1
        watermark = progress.eventTime.get("watermark", watermark)
        for op in progress.stateOperators:
            run.dropped += op.numRowsDroppedByWatermark
            run.state_rows, run.state_left = max(run.state_rows, op.numRowsTotal), op.numRowsTotal
    if run.dropped:
        past = spark.read.schema(schema).parquet(source_path).where(F.col(event_time) <= F.to_timestamp(F.lit(watermark)).cast("timestamp_ntz"))
        stored = target.read()
        missing = past if stored is None else past.join(stored.select(*key), key, "left_anti")
        target.apply(transform(dedupe_latest(missing, key, [event_time])))
    return run
