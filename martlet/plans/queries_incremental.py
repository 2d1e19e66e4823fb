"""Incremental materialisation queries (A3-A12 sinks, B1-B20, J15-J17).

Each query materialises a model into a fresh folder under the session's
checkpoint folder - first from the source as it stood at ``t0``, then
incrementally from the whole source - and returns the target as read back.
Unless a key documents otherwise, the oracle is the full-refresh SQL: an
increment must leave the target equal to a rebuild from scratch.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.operators.incremental import (
    after_per_key_mark, mark_condition, per_key_marks)
from martlet.plans import incremental_models as IM
from martlet.plans import orders as M
from martlet.plans.params import FIXTURE, resolve_as_of
from martlet.plans.queries_models import EXPENSIVE_ITEMS_SQL, ITEM_TYPE_COUNTS_SQL, ORDERS_WITH_CUSTOMER_SQL
from martlet.plans.registry import register
from martlet.session import scratch_path
from martlet.sources.catalog import Catalog
from martlet.sources.sinks import Layout, choose_layout, full_refresh, read_table, switched_layout
from martlet.sources.target import IncrementalConfig, Target

P = FIXTURE
T0 = dt.datetime(2001, 1, 1)             # split of history for two-step loads
T0_MID_MONTH = dt.datetime(2000, 12, 15)
T0_SQL = "TIMESTAMP '2001-01-01 00:00:00'"


def _before(cat: Catalog, t0: dt.datetime) -> Catalog:
    return cat.with_filter("fct_orders", F.col("ordered_at") < F.lit(t0))


def _target(cat: Catalog, name: str, cfg: IncrementalConfig) -> Target:
    return Target(cat.spark, scratch_path(cat.spark, name), cfg)


# ------------------------------------------------------------------ J15 / B1-B5, B12, B18, B19
def _orders_two_step(cat: Catalog, name: str, cfg=IM.ORDERS_WITH_CUSTOMER_MONTHLY, t0=T0, repeat: int = 1,
                     **kw) -> DataFrame:
    target = _target(cat, name, cfg)
    IM.refresh_orders_with_customer(_before(cat, t0), target)
    for _ in range(repeat):
        IM.refresh_orders_with_customer(cat, target, **kw)
    return target.read().select(*IM.J15_COLUMNS)


register("j15_orders_with_customer_incremental", ORDERS_WITH_CUSTOMER_SQL)(
    lambda cat: _orders_two_step(cat, "j15", IM.ORDERS_WITH_CUSTOMER))


@register("b01_first_load_then_full_refresh", ORDERS_WITH_CUSTOMER_SQL)
def _b01(cat: Catalog) -> DataFrame:
    target = _target(cat, "b01", IM.ORDERS_WITH_CUSTOMER_MONTHLY)
    IM.refresh_orders_with_customer(_before(cat, T0), target)
    IM.refresh_orders_with_customer(cat, target, full_refresh=True)
    return target.read().select(*IM.J15_COLUMNS)


register("b02_strict_mark_append", ORDERS_WITH_CUSTOMER_SQL)(
    lambda cat: _orders_two_step(cat, "b02", dataclasses.replace(IM.ORDERS_WITH_CUSTOMER_MONTHLY, strategy="append")))

# Inclusive mark re-reads the mark's rows; the keyed merge keeps the replay idempotent.
register("b03_inclusive_mark_idempotent", ORDERS_WITH_CUSTOMER_SQL)(
    lambda cat: _orders_two_step(cat, "b03", repeat=2, inclusive=True))

# Empty target: without a default the mark is NULL and selects nothing.
register("b04_null_safe_mark", ORDERS_WITH_CUSTOMER_SQL)(
    lambda cat: _orders_two_step(cat, "b04", t0=dt.datetime(1900, 1, 1),
                                 mark_default=dt.datetime(1900, 1, 1)))

register("b05_day_lookback_merge", ORDERS_WITH_CUSTOMER_SQL)(
    lambda cat: _orders_two_step(cat, "b05", lookback_days=3))

register("b12_upsert_single_key", ORDERS_WITH_CUSTOMER_SQL)(
    lambda cat: _orders_two_step(cat, "b12", repeat=2, lookback_days=10))

register("b19_schema_fail_unchanged", ORDERS_WITH_CUSTOMER_SQL)(
    lambda cat: _orders_two_step(cat, "b19", dataclasses.replace(IM.ORDERS_WITH_CUSTOMER_MONTHLY,
                                                                 on_schema_change="fail")))


@register("b09_mark_on_model_output", ORDERS_WITH_CUSTOMER_SQL)
def _b09(cat: Catalog) -> DataFrame:
    """The mark filters the model's final rows (Catalyst pushes it to the scan)."""
    cfg = dataclasses.replace(IM.ORDERS_WITH_CUSTOMER_MONTHLY, strategy="append")
    target = _target(cat, "b09", cfg)
    target.load_full(M.orders_with_customer(_before(cat, T0)))
    mark = target.mark("ordered_at")
    target.apply(M.orders_with_customer(cat).where(mark_condition("ordered_at", mark)))
    return target.read().select(*IM.J15_COLUMNS)


@register("b10_per_key_mark", ORDERS_WITH_CUSTOMER_SQL)
def _b10(cat: Catalog) -> DataFrame:
    cfg = dataclasses.replace(IM.ORDERS_WITH_CUSTOMER_MONTHLY, strategy="append")
    target = _target(cat, "b10", cfg)
    target.load_full(M.orders_with_customer(_before(cat, T0)))
    marks = per_key_marks(target.read(), ["customer_id"], "ordered_at")
    target.apply(after_per_key_mark(M.orders_with_customer(cat), marks, ["customer_id"], "ordered_at"))
    return target.read().select(*IM.J15_COLUMNS)


@register("b18_schema_sync_all_columns", f"""
SELECT o.order_id, o.customer_id, c.name AS customer_name, o.order_total, o.ordered_at,
       CASE WHEN o.ordered_at >= {T0_SQL} THEN CAST(year(o.ordered_at) AS INTEGER) END AS order_year
FROM fct_orders o LEFT JOIN dim_customers c ON c.customer_id = o.customer_id""")
def _b18(cat: Catalog) -> DataFrame:
    target = _target(cat, "b18", IM.ORDERS_WITH_CUSTOMER_MONTHLY)
    old = M.orders_with_customer(_before(cat, T0)).withColumn("legacy_flag", F.lit(1))
    target.load_full(old)
    mark = target.mark("ordered_at")
    new = (M.orders_with_customer(cat).where(mark_condition("ordered_at", mark))
           .withColumn("order_year", F.year("ordered_at")))
    target.apply(new)
    return target.read().select(*IM.J15_COLUMNS, "order_year")


# ------------------------------------------------------------------ J16 / B7, B15
def _recent_two_step(cat: Catalog, name: str, first_days: int, later_days: int) -> DataFrame:
    as_of = resolve_as_of(cat, P)
    t0 = as_of - dt.timedelta(days=later_days)
    target = _target(cat, name, IM.RECENT_PRODUCTS)
    first = cat.with_filter("fct_orders", F.to_date("ordered_at") <= F.lit(t0))
    IM.refresh_recent_products(first, target, t0, first_days=first_days, later_days=later_days)
    IM.refresh_recent_products(cat, target, as_of, first_days=first_days, later_days=later_days)
    return target.read().select(*IM.J16_COLUMNS)


def _recent_sql(days: int) -> str:
    return f"""
SELECT DISTINCT oi.product_id, oi.product_price, o.ordered_at
FROM fct_orders o JOIN order_items oi ON o.order_id = oi.order_id
WHERE CAST(o.ordered_at AS DATE) >= CAST((SELECT max(CAST(ordered_at AS DATE)) FROM fct_orders)
                                         - INTERVAL {days} DAY AS DATE)"""


register("j16_recent_products_incremental", _recent_sql(93))(lambda cat: _recent_two_step(cat, "j16", 90, 3))
register("b07_rolling_window", _recent_sql(37))(lambda cat: _recent_two_step(cat, "b07", 30, 7))
register("b15_insert_overwrite", _recent_sql(93))(lambda cat: _recent_two_step(cat, "b15", 90, 3))


# ------------------------------------------------------------------ J17 / B6, B13, B20
MONTHLY_RANK_SQL = """
WITH agg AS (
  SELECT strftime(o.ordered_at, '%Y-%m') AS order_month,
         CAST(date_trunc('month', o.ordered_at) AS DATE) AS order_month_date,
         oi.product_id, round(sum(oi.product_price), 2) AS total_revenue
  FROM fct_orders o JOIN order_items oi ON o.order_id = oi.order_id
  GROUP BY 1, 2, 3)
SELECT order_month, order_month_date, product_id, total_revenue,
       CAST(rank() OVER (PARTITION BY order_month ORDER BY total_revenue DESC) AS BIGINT) AS rank
FROM agg"""


def _monthly_two_step(cat: Catalog, name: str, t0: dt.datetime, cfg=IM.MONTHLY_RANK) -> DataFrame:
    target = _target(cat, name, cfg)
    IM.refresh_monthly_rank(_before(cat, t0), target)
    IM.refresh_monthly_rank(cat, target)
    return target.read().select(*IM.J17_COLUMNS)


register("j17_monthly_rank_incremental", MONTHLY_RANK_SQL)(lambda cat: _monthly_two_step(cat, "j17", T0))
register("b06_month_lookback", MONTHLY_RANK_SQL)(
    lambda cat: _monthly_two_step(cat, "b06", dt.datetime(2001, 3, 1)))
register("b13_upsert_composite_key", MONTHLY_RANK_SQL)(
    lambda cat: _monthly_two_step(cat, "b13", T0_MID_MONTH,
                                  dataclasses.replace(IM.MONTHLY_RANK, strategy="merge")))
register("b20_whole_month_recompute", MONTHLY_RANK_SQL)(
    lambda cat: _monthly_two_step(cat, "b20", T0_MID_MONTH))


@register("b08_rolling_month_window", """
WITH agg AS (
  SELECT strftime(o.ordered_at, '%Y-%m') AS order_month,
         CAST(date_trunc('month', o.ordered_at) AS DATE) AS order_month_date,
         oi.product_id, round(sum(oi.product_price), 2) AS total_revenue
  FROM fct_orders o JOIN order_items oi ON o.order_id = oi.order_id
  WHERE o.ordered_at >= CAST(date_trunc('month', (SELECT max(CAST(ordered_at AS DATE)) FROM fct_orders)
                                        - INTERVAL 6 MONTH) AS TIMESTAMP)
  GROUP BY 1, 2, 3)
SELECT order_month, order_month_date, product_id, total_revenue,
       CAST(rank() OVER (PARTITION BY order_month ORDER BY total_revenue DESC) AS BIGINT) AS rank
FROM agg""")
def _b08(cat: Catalog) -> DataFrame:
    """Months from trunc(as_of - 6 months); the filter precedes the grouping."""
    as_of = resolve_as_of(cat, P)
    m = as_of.month - 6
    start = dt.date(as_of.year + (m - 1) // 12, (m - 1) % 12 + 1, 1)
    return IM.monthly_rank_rows(cat, since=start)


# ------------------------------------------------------------------ B11, B14, B16, B17
ITEM_ROWS_SQL = """
SELECT oi.order_item_id, oi.order_id, oi.product_id, oi.product_price, o.ordered_at
FROM order_items oi JOIN fct_orders o ON oi.order_id = o.order_id"""


def _item_rows(cat: Catalog) -> DataFrame:
    return (cat.table("order_items").select("order_item_id", "order_id", "product_id", "product_price")
            .join(cat.table("fct_orders").select("order_id", "ordered_at"), "order_id")
            .select("order_item_id", "order_id", "product_id", "product_price", "ordered_at"))


ITEM_LAYOUT = Layout(partition_field="ordered_at", partition_kind="month", cluster_by=("order_id",))


@register("b11_restrict_to_affected_keys", f"""
SELECT * FROM order_items
WHERE order_id IN (SELECT order_id FROM fct_orders WHERE ordered_at >= {T0_SQL})""")
def _b11(cat: Catalog) -> DataFrame:
    changed = cat.table("fct_orders").where(F.col("ordered_at") >= F.lit(T0)).select("order_id")
    return cat.table("order_items").join(changed, "order_id", "left_semi")


@register("b14_delete_insert", ITEM_ROWS_SQL)
def _b14(cat: Catalog) -> DataFrame:
    """Key (order_id) coarser than the rows: every batch row is kept."""
    cfg = IncrementalConfig(layout=ITEM_LAYOUT, unique_key=("order_id",), strategy="delete+insert")
    target = _target(cat, "b14", cfg)
    target.load_full(_item_rows(_before(cat, T0)))
    mark = target.mark("ordered_at")
    target.apply(_item_rows(cat).where(mark_condition("ordered_at", mark, lookback_days=5)))
    return target.read().select("order_item_id", "order_id", "product_id", "product_price", "ordered_at")


@register("b16_append_only", ITEM_ROWS_SQL)
def _b16(cat: Catalog) -> DataFrame:
    cfg = IncrementalConfig(layout=ITEM_LAYOUT, strategy="append")
    target = _target(cat, "b16", cfg)
    target.load_full(_item_rows(_before(cat, T0)))
    mark = target.mark("ordered_at")
    target.apply(_item_rows(cat).where(mark_condition("ordered_at", mark)))
    return target.read().select("order_item_id", "order_id", "product_id", "product_price", "ordered_at")


@register("b17_one_row_per_key_in_batch", """
SELECT product_id, order_id, product_price, ordered_at FROM (
  SELECT oi.product_id, oi.order_id, oi.product_price, o.ordered_at,
         row_number() OVER (PARTITION BY oi.product_id
                            ORDER BY o.ordered_at DESC, oi.order_id DESC, oi.product_price DESC) AS rn
  FROM order_items oi JOIN fct_orders o ON oi.order_id = o.order_id) t
WHERE rn = 1""")
def _b17(cat: Catalog) -> DataFrame:
    """Latest order per product; batches hold many rows per product."""
    cfg = IncrementalConfig(layout=Layout(partition_field="ordered_at", partition_kind="month"),
                            unique_key=("product_id",), strategy="merge", dedupe_by=("ordered_at",))

    def rows(c: Catalog) -> DataFrame:
        return _item_rows(c).select("product_id", "order_id", "product_price", "ordered_at")

    target = _target(cat, "b17", cfg)
    target.apply(rows(_before(cat, T0)))
    mark = target.mark("ordered_at")
    target.apply(rows(cat).where(mark_condition("ordered_at", mark)))
    return target.read().select("product_id", "order_id", "product_price", "ordered_at")


# ------------------------------------------------------------------ sinks A3-A12
def _round_trip(cat: Catalog, name: str, df: DataFrame, layout: Layout) -> DataFrame:
    root = scratch_path(cat.spark, name)
    full_refresh(df, root, layout)
    out = read_table(cat.spark, root, schema=df.schema)
    return out.select(*df.columns)


register("a03_full_refresh_table", ORDERS_WITH_CUSTOMER_SQL)(
    lambda cat: _round_trip(cat, "a03", M.orders_with_customer(cat), Layout()))
register("a04_partition_by_timestamp_day", ORDERS_WITH_CUSTOMER_SQL)(
    lambda cat: _round_trip(cat, "a04", M.orders_with_customer(cat),
                            Layout(partition_field="ordered_at", partition_kind="day")))
register("a05_partition_by_date", """
SELECT o.order_id, o.customer_id, o.order_total, CAST(o.ordered_at AS DATE) AS order_date
FROM fct_orders o""")(
    lambda cat: _round_trip(cat, "a05", cat.table("fct_orders").select(
        "order_id", "customer_id", "order_total", F.to_date("ordered_at").alias("order_date")),
        Layout(partition_field="order_date", partition_kind="date")))
register("a06_partition_by_month", ORDERS_WITH_CUSTOMER_SQL)(
    lambda cat: _round_trip(cat, "a06", M.orders_with_customer(cat),
                            Layout(partition_field="ordered_at", partition_kind="month")))
register("a07_partition_by_integer_range", EXPENSIVE_ITEMS_SQL)(
    lambda cat: _round_trip(cat, "a07", M.expensive_items_of_high_value(cat, P),
                            Layout(partition_field="product_id", partition_kind="range",
                                   range_start=0, range_end=100_000_000, range_interval=1000)))
register("a08_partition_by_string", ITEM_TYPE_COUNTS_SQL)(
    lambda cat: _round_trip(cat, "a08", M.item_type_counts(cat, P),
                            Layout(partition_field="item_type", partition_kind="value")))
register("a09_clustered_sink", ORDERS_WITH_CUSTOMER_SQL)(
    lambda cat: _round_trip(cat, "a09", M.orders_with_customer(cat),
                            Layout(partition_field="ordered_at", partition_kind="day",
                                   cluster_by=("customer_id",))))


def _email_sql_for(user: str) -> str:
    from martlet.plans.queries_models import email_sql
    return email_sql(user)


def _email(cat: Catalog) -> DataFrame:
    from martlet.plans.email_activity import email_activity
    return email_activity(cat, P)


register("a10_distributed_sorted_sink", _email_sql_for("analyst"))(
    lambda cat: _round_trip(cat, "a10", _email(cat),
                            Layout(distribute_by="terr_id", sort_by=("prod_nm",))))
register("a11_even_compound_sorted_sink", _email_sql_for("analyst"))(
    lambda cat: _round_trip(cat, "a11", _email(cat),
                            Layout(even=True, sort_by=("year", "ciclo", "prod_nm", "terr_id"))))


@register("a12_layout_chosen_by_schema", """
SELECT c.name AS customer_name, round(sum(o.order_total), 2) AS total_spent
FROM fct_orders o JOIN dim_customers c ON o.customer_id = c.customer_id
GROUP BY c.name""")
def _a12(cat: Catalog) -> DataFrame:
    df = M.spend_per_customer_name(cat, P, how="inner")
    by_date = Layout(partition_field="order_date", partition_kind="date")
    layout = choose_layout(df, "order_date", by_date, Layout(cluster_by=("customer_name",)))
    return _round_trip(cat, "a12", df, layout)



# What the layout leaves on disk: rows by the partition folder that holds them, by the names of the folders.
def _folders(cat: Catalog, name: str, df: DataFrame, layout: Layout) -> DataFrame:
    path = full_refresh(df, scratch_path(cat.spark, name), layout)
    file = cat.spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"))
    folder = F.regexp_extract("file", f"/{layout.partition_column}=([^/]*)/", 1)
    return file.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"))


register("a04_folders_by_timestamp_day", "SELECT strftime(ordered_at, '%Y-%m-%d') AS folder, count(*) AS n_rows FROM fct_orders GROUP BY 1")(
    lambda cat: _folders(cat, "a04", cat.table("fct_orders"), Layout(partition_field="ordered_at", partition_kind="day")))
register("a05_folders_by_date", "SELECT strftime(ordered_at, '%Y-%m-%d') AS folder, count(*) AS n_rows FROM fct_orders GROUP BY 1")(
    lambda cat: _folders(cat, "a05", cat.table("fct_orders").select("order_id", F.to_date("ordered_at").alias("order_date")),
                         Layout(partition_field="order_date", partition_kind="date")))
register("a06_folders_by_month", "SELECT strftime(ordered_at, '%Y-%m-01') AS folder, count(*) AS n_rows FROM fct_orders GROUP BY 1")(
    lambda cat: _folders(cat, "a06", cat.table("fct_orders"), Layout(partition_field="ordered_at", partition_kind="month")))
register("a07_folders_by_integer_range", """
SELECT CASE WHEN customer_id BETWEEN 10 AND 109 THEN CAST((customer_id - 10) // 25 * 25 + 10 AS VARCHAR) ELSE '__HIVE_DEFAULT_PARTITION__' END AS folder,
       count(*) AS n_rows FROM fct_orders GROUP BY 1""")(
    lambda cat: _folders(cat, "a07", cat.table("fct_orders"), Layout(partition_field="customer_id", partition_kind="range", range_start=10, range_end=110, range_interval=25)))
register("a08_folders_by_string", f"SELECT item_type AS folder, count(*) AS n_rows FROM ({ITEM_TYPE_COUNTS_SQL}) GROUP BY 1")(
    lambda cat: _folders(cat, "a08", M.item_type_counts(cat, P), Layout(partition_field="item_type", partition_kind="value")))


def _files(cat: Catalog, name: str, df: DataFrame, layout: Layout, *measures) -> DataFrame:
    """One row a written file, in the order of its least key."""
    path = full_refresh(df, scratch_path(cat.spark, name), layout)
    return cat.spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(*measures)


@register("a09_files_hold_key_ranges", "SELECT 4 AS files, 0 AS overlapping, CAST(count(*) AS BIGINT) AS n_rows FROM fct_orders")
def _a09_files(cat: Catalog) -> DataFrame:
    """Four files of neighbouring customers: none begins before the one in front of it ends (a shared customer may be cut in two)."""
    files = _files(cat, "a09", cat.table("fct_orders"), Layout(cluster_by=("customer_id",), num_parts=4),
                   F.min("customer_id").alias("lo"), F.max("customer_id").alias("hi"), F.count(F.lit(1)).alias("n")).orderBy("lo", "hi").collect()
    overlapping = sum(a.hi > b.lo for a, b in zip(files, files[1:]))
    return cat.spark.createDataFrame([(len(files), overlapping, sum(f.n for f in files))], "files int, overlapping int, n_rows long")


@register("a11_files_are_even", "SELECT 4 AS files, true AS even, CAST(count(*) AS BIGINT) AS n_rows FROM fct_orders")
def _a11_files(cat: Catalog) -> DataFrame:
    files = _files(cat, "a11", cat.table("fct_orders"), Layout(even=True, sort_by=("customer_id", "ordered_at"), num_parts=4), F.count(F.lit(1)).alias("n")).collect()
    n = sorted(f.n for f in files)
    return cat.spark.createDataFrame([(len(n), n[-1] <= 1.1 * n[0] + 10, sum(n))], "files int, even boolean, n_rows long")


@register("a12_layout_by_run_variable", """
SELECT on_ AS partitioned, customer_id, round(sum(order_total), 2) AS total_spent
FROM fct_orders CROSS JOIN (VALUES (true), (false)) v(on_) GROUP BY 1, 2""")
def _a12_variable(cat: Catalog) -> DataFrame:
    """One model stored under both settings of a run variable; ``partitioned`` is read off the files' paths."""
    rows = cat.table("fct_orders").groupBy("customer_id").agg(F.round(F.sum("order_total"), 2).alias("total_spent"))
    by_range = {"partition_field": "customer_id", "partition_kind": "range", "range_end": None, "range_interval": 1000}
    out = []
    for variables in ({}, {"enable_partitioning": True}):
        layout = switched_layout(variables, ("enable_partitioning", False, by_range), ("enable_clustering", True, {"cluster_by": ("total_spent",)}))
        path = full_refresh(rows, scratch_path(cat.spark, "a12"), layout)
        out.append(cat.spark.read.parquet(path).select(F.col("_metadata.file_path").contains("customer_id_range=").alias("partitioned"), "customer_id", "total_spent"))
    return out[0].unionByName(out[1])


# ------------------------------------------------------------------ streaming form of J15
@register("j15_orders_with_customer_streaming", ORDERS_WITH_CUSTOMER_SQL)
def _j15_stream(cat: Catalog) -> DataFrame:
    """New order files are discovered by a file-source stream instead of a mark;
    each micro-batch is upserted with the same ``Target.apply``."""
    from martlet.streaming.refresh import run_refresh

    spark = cat.spark
    landing = scratch_path(spark, "landing")
    orders = cat.table("fct_orders")
    target = _target(cat, "j15s", IM.ORDERS_WITH_CUSTOMER_MONTHLY)
    checkpoint = scratch_path(spark, "stream-ckpt")

    def enrich(batch: DataFrame) -> DataFrame:
        return M.orders_with_customer(cat.with_table("fct_orders", batch))

    # Two deliveries of files: history before t0, then the rest.
    orders.where(F.col("ordered_at") < F.lit(T0)).write.mode("append").parquet(landing)
    run_refresh(spark, landing, orders.schema, target, enrich, checkpoint)
    orders.where(F.col("ordered_at") >= F.lit(T0)).write.mode("append").parquet(landing)
    run_refresh(spark, landing, orders.schema, target, enrich, checkpoint)
    return target.read().select(*IM.J15_COLUMNS)
