"""A key holding a third of the rows must not end up in one task."""

import datetime as dt
import os

from pyspark.sql import functions as F

from martlet.session import scratch_path
from martlet.sources.sinks import Layout, write_parquet


def _skewed_orders(spark, n=30_000):
    # customer 1 / day 2024-01-01 hold a third of all rows
    return spark.range(n).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 1000 + 2).alias("customer_id"),
        (F.col("id") % 97).cast("double").alias("order_total"),
        F.when(F.col("id") % 3 == 0, F.lit(dt.datetime(2024, 1, 1, 12)))
         .otherwise(F.lit(dt.datetime(2024, 1, 2)) + F.expr("make_interval(0, 0, 0, cast(id % 300 as int))"))
         .cast("timestamp_ntz").alias("ordered_at"))


def test_hot_partition_value_is_written_by_several_tasks(spark):
    path = scratch_path(spark, "skew-write")
    df = _skewed_orders(spark)
    write_parquet(df, path, Layout(partition_field="ordered_at", partition_kind="day",
                                   cluster_by=("customer_id",), num_parts=8))
    hot = os.path.join(path.replace("file:", ""), "ordered_at_day=2024-01-01")
    files = [f for f in os.listdir(hot) if f.endswith(".parquet")]
    assert len(files) >= 2, files          # the hot day is split across tasks
    back = spark.read.parquet(path)
    assert back.count() == df.count()
    assert back.where("ordered_at_day = DATE'2024-01-01'").count() == 10_000


def test_hot_key_is_pre_aggregated_before_the_shuffle(spark):
    from martlet.sources.catalog import Catalog
    from martlet.plans import orders as M
    df = _skewed_orders(spark)
    dim = spark.range(0, 1100).select(F.col("id").alias("customer_id"),
                                      F.concat(F.lit("c"), F.col("id").cast("string")).alias("name"))
    cat = Catalog(spark, {"fct_orders": lambda: df, "dim_customers": lambda: dim})
    out = M.spend_per_customer_name(cat)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan             # map-side combine before the exchange
    got = {r.customer_name: r.total_spent for r in out.collect()}
    want = {r.customer_name: r.total_spent for r in df.join(dim, "customer_id")
            .groupBy(F.col("name").alias("customer_name"))
            .agg(F.round(F.sum("order_total"), 2).alias("total_spent")).collect()}
    assert got == want
