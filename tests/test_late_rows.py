"""The stateful stream keeps every key once, forgets what is past the watermark, and loses nothing."""

import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from martlet.plans import incremental_models as IM
from martlet.session import scratch_path
from martlet.sources.target import Target
from martlet.streaming.late_rows import run_late_refresh

SCHEMA = "order_id long, customer_id long, order_total double, ordered_at timestamp_ntz"


def test_late_and_repeated_files(spark):
    def rows(lo, hi):
        return [(i, i % 7, float(i), dt.datetime(2020, 1, 1) + dt.timedelta(days=i)) for i in range(lo, hi)]

    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "ckpt")
    cfg = dataclasses.replace(IM.ORDERS_WITH_CUSTOMER_BY_MONTH, unique_key=("order_id",))
    target = Target(spark, scratch_path(spark, "late"), cfg)

    def deliver(*parts):
        for part in parts:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        return run_late_refresh(spark, landing, spark.createDataFrame([], SCHEMA).schema, target, lambda b: b, checkpoint, "ordered_at", "30 days", files_per_batch=1)

    first = deliver(rows(100, 300), rows(280, 400) + rows(280, 400), rows(390, 600))
    assert (first.batches >= 3, first.dropped) == (True, 0)
    assert first.state_left <= 61 and first.state_rows < 500         # of 500 keys those of twice the delay are left
    second = deliver(rows(575, 590), rows(50, 120) + rows(60, 70))    # again, within the delay; far too late, partly known
    assert second.dropped >= 70
    got = target.read().select("order_id", "order_total").orderBy("order_id").collect()
    assert [tuple(r) for r in got] == [(i, float(i)) for i in range(50, 600)]
    assert target.read().where(F.col("order_id") < 100).count() == 50
