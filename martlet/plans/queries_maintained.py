"""Queries of the maintained models: a first load, increments, replays, late rows and corrections, then the full SQL.

The history is cut by time, so that every row of the tables arrives in some batch; the oracle knows nothing of batches.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.plans import incremental_models as IM
from martlet.plans import orders as M
from martlet.plans.dimension_changes import propagate
from martlet.plans.maintained import Batch, HighValueItems, RecentProducts, Spend, TypeCounts, batch_of
from martlet.plans.params import FIXTURE, resolve_as_of
from martlet.plans.queries_models import EXPENSIVE_ITEMS_SQL, ITEM_TYPE_COUNTS_SQL, ORDERS_WITH_CUSTOMER_SQL, SPEND_PER_CUSTOMER_SQL
from martlet.plans.registry import register
from martlet.session import scratch_path
from martlet.sources.bucketed import BucketedTable, join_bucketed
from martlet.sources.catalog import Catalog
from martlet.sources.footers import stored_max
from martlet.sources.sinks import Layout, full_refresh, read_table
from martlet.sources.target import Target
from martlet.streaming.late_rows import run_late_refresh

P = FIXTURE
FIRST, SECOND = dt.datetime(2000, 7, 1), dt.datetime(2001, 2, 1)
BUCKETS = 4                                                        # the fixtures are small
LATE = (dt.datetime(1999, 3, 1), dt.datetime(1999, 6, 1))          # orders of this quarter arrive last


def _between(lo, hi):
    at = F.col("ordered_at")
    return (at >= F.lit(lo) if lo else F.lit(True)) & (at < F.lit(hi) if hi else F.lit(True))


def _late():
    return _between(*LATE)


def _deliveries(cat: Catalog) -> list[Batch]:
    """First load without the late quarter, two increments, the second again, then the late quarter."""
    second = batch_of(cat, "increment 2", _between(SECOND, None))
    return [batch_of(cat, "first", _between(None, FIRST) & ~_late()), batch_of(cat, "increment 1", _between(FIRST, SECOND)), second, second,
            batch_of(cat, "late", _late())]


def _spend(cat: Catalog) -> Spend:
    state = Spend(cat.spark, scratch_path(cat.spark, "spend"), BUCKETS)
    for batch in _deliveries(cat):
        state.apply(batch)
    state.log.compact()
    return state


register("j02_spend_per_customer_incremental", SPEND_PER_CUSTOMER_SQL)(lambda cat: _spend(cat).by_name(cat.table("dim_customers")))

register("j09_spend_and_last_order_incremental", """
SELECT c.name AS customer_name, round(t.spent, 2) AS total_spent, t.latest AS last_order_date
FROM (SELECT customer_id, sum(order_total) AS spent, max(ordered_at) AS latest FROM fct_orders GROUP BY customer_id) t
     JOIN dim_customers c USING (customer_id)""")(lambda cat: _spend(cat).with_last_order(cat.table("dim_customers")))


def _wrong_first(cat: Catalog) -> tuple[Batch, Batch]:
    """A first load with mistakes, and the batch that corrects them.

    The late quarter's orders are first booked on the customer with the next id and with only their first line's items, and
    each of them has a double under another id, which is deleted later.
    """
    orders, items = cat.table("fct_orders"), cat.table("order_items")
    wrong = orders.where(_late()).withColumn("customer_id", F.col("customer_id") + 1).withColumn("order_total", F.col("order_total") * 2)
    double = orders.where(_late()).withColumn("order_id", -F.col("order_id") - 1)
    right = orders.where(_between(None, FIRST) & ~_late())
    line = F.split("order_item_id", "-")[1] == "1"
    some = items.join(wrong.select("order_id"), "order_id", "left_semi").where(line)
    doubles = items.join(orders.where(_late()).select("order_id"), "order_id", "left_semi").withColumn("order_id", -F.col("order_id") - 1)
    kept = items.join(right.select("order_id"), "order_id", "left_semi")
    rows = cat.with_table("fct_orders", right.unionByName(wrong).unionByName(double)).with_table("order_items", kept.unionByName(some).unionByName(doubles))
    fixed = batch_of(cat, "corrections", _late(), double.select("order_id"))
    return Batch("first", rows), fixed


def _corrected(cat: Catalog) -> list[Batch]:
    first, fixed = _wrong_first(cat)
    return [first, batch_of(cat, "increment 1", _between(FIRST, SECOND)), fixed, fixed, batch_of(cat, "increment 2", _between(SECOND, None))]


@register("j04_item_type_counts_incremental", ITEM_TYPE_COUNTS_SQL)
def _j04(cat: Catalog) -> DataFrame:
    state = TypeCounts(cat.spark, scratch_path(cat.spark, "counts"), BUCKETS)
    for batch in _corrected(cat):
        state.apply(batch)
    return state.result(cat.table("dim_customers"))


@register("j05_expensive_items_incremental", EXPENSIVE_ITEMS_SQL)
def _j05(cat: Catalog) -> DataFrame:
    state = HighValueItems(cat.spark, scratch_path(cat.spark, "high-value"), P, BUCKETS)
    for batch in _corrected(cat):
        state.apply(batch)
    return state.result(cat.table("dim_customers"))


@register("j16_recent_products_moving_window", """
SELECT DISTINCT i.product_id, i.product_price, o.ordered_at
FROM fct_orders o JOIN order_items i USING (order_id)
WHERE CAST(o.ordered_at AS DATE) >= (SELECT CAST(max(ordered_at) AS DATE) - 90 FROM fct_orders)""")
def _j16(cat: Catalog) -> DataFrame:
    """90 days as of a month before the end; then as of two weeks before, with orders of three days delivered again; then the rest, twice."""
    end = resolve_as_of(cat, P)
    state = RecentProducts(cat.spark, scratch_path(cat.spark, "recent"))
    day = F.to_date("ordered_at")
    a, b = end - dt.timedelta(days=30), end - dt.timedelta(days=14)
    late = (day >= F.lit(a - dt.timedelta(days=20))) & (day < F.lit(a - dt.timedelta(days=15)))
    state.apply(batch_of(cat, "first", (day <= F.lit(a)) & (day >= F.lit(a - dt.timedelta(days=90))) & ~late), a)
    state.apply(batch_of(cat, "second", (day > F.lit(a - dt.timedelta(days=3))) & (day <= F.lit(b))), b)
    rest = batch_of(cat, "third", (day > F.lit(b)) | late)
    state.apply(rest, end)
    state.apply(rest, end)
    return state.result(end)


@register("j15_late_dimension_change", """
SELECT o.order_id, o.customer_id, (SELECT max(c.name) FROM dim_customers c WHERE c.customer_id = o.customer_id) AS customer_name,
       o.order_total, o.ordered_at
FROM fct_orders o""")
def _j15(cat: Catalog) -> DataFrame:
    """Orders stored with a dimension in which the first twenty customers have other names or are not known yet; the true one comes with an increment."""
    customers = cat.table("dim_customers")
    before = customers.where("customer_id > 10").withColumn("name", F.when(F.col("customer_id") <= 20, F.concat("name", F.lit(" (old)"))).otherwise(F.col("name")))
    target = Target(cat.spark, scratch_path(cat.spark, "j15-late"), IM.ORDERS_WITH_CUSTOMER_BY_MONTH)
    snapshots = scratch_path(cat.spark, "j15-dimension")
    then = cat.with_filter("fct_orders", _between(None, SECOND)).with_table("dim_customers", before)
    for at in (then, cat):
        IM.refresh_orders_with_customer(at, target)
        propagate(target, at.table("dim_customers"), snapshots, "customer_id", {"name": "customer_name"})
    return target.read().select(*IM.J15_COLUMNS)


# ------------------------------------------------------------------ A9, A10, E4: stored layouts that readers use
@register("a09_clustered_on_two_columns", ORDERS_WITH_CUSTOMER_SQL)
def _a09_curve(cat: Catalog) -> DataFrame:
    """J1 clustered on (customer, time) alike: filters on either skip row groups (tests/test_storage.py looks at the footers)."""
    rows = M.orders_with_customer(cat)
    root = scratch_path(cat.spark, "a09-curve")
    full_refresh(rows, root, Layout(cluster_by=("customer_id", "ordered_at"), curve=True))
    return read_table(cat.spark, root, schema=rows.schema).select(*rows.columns)


@register("a10_join_of_bucketed_tables", """
SELECT o.order_id, c.customer_id, c.name, o.order_total
FROM fct_orders o JOIN dim_customers c USING (customer_id)""")
def _a10_join(cat: Catalog) -> DataFrame:
    """Orders and customers stored in the same buckets; their join needs no shuffle."""
    spark, stored = cat.spark, {}
    for name in ("fct_orders", "dim_customers"):
        path = scratch_path(spark, f"bucketed-{name}")
        stored[name] = BucketedTable(spark, f"{name}_{path.rsplit('-', 1)[1]}", path, "customer_id", 8)
        stored[name].save(cat.table(name))
    return join_bucketed(stored["fct_orders"], stored["dim_customers"]).select("order_id", "customer_id", "name", "order_total")


@register("e04_maximum_from_footers", """
SELECT max(ordered_at) AS last_order, max(customer_id) AS last_customer, max(order_total) AS largest FROM fct_orders""")
def _e04_stored(cat: Catalog) -> DataFrame:
    root = scratch_path(cat.spark, "e04")
    path = full_refresh(cat.table("fct_orders"), root, Layout(partition_field="ordered_at", partition_kind="month"))
    told = {alias: stored_max(cat.spark, path, column) for alias, column in (("last_order", "ordered_at"), ("last_customer", "customer_id"), ("largest", "order_total"))}
    return cat.spark.createDataFrame([tuple(told.values())], "last_order timestamp_ntz, last_customer long, largest double")


register("d12_single_match_lookup_without_nested_loop", ORDERS_WITH_CUSTOMER_SQL)(
    lambda cat: M.orders_with_customer(cat, strict=True))


# ------------------------------------------------------------------ B5 / B17: late and repeated files by event time
def late_deliveries(cat: Catalog, landing: str) -> list:
    """Writes the orders file by file: history, an increment that repeats its last weeks and brings a late week, that file again, the rest,
    and a quarter that comes years late."""
    at = F.col("ordered_at")
    week = _between(FIRST - dt.timedelta(days=12), FIRST - dt.timedelta(days=5))
    parts = [_between(None, FIRST) & ~_late() & ~week, _between(FIRST - dt.timedelta(days=25), SECOND), _between(FIRST - dt.timedelta(days=25), SECOND),
             _between(SECOND, None), _late()]
    for condition in parts:
        cat.table("fct_orders").where(condition & at.isNotNull()).coalesce(1).write.mode("append").parquet(landing)
    return parts


@register("b05_late_rows_streaming", ORDERS_WITH_CUSTOMER_SQL)
def _b05_stream(cat: Catalog) -> DataFrame:
    spark = cat.spark
    landing, target = scratch_path(spark, "late"), Target(spark, scratch_path(spark, "b05s"), IM.ORDERS_WITH_CUSTOMER_BY_MONTH)
    late_deliveries(cat, landing)
    run_late_refresh(spark, landing, cat.table("fct_orders").schema, target, lambda batch: M.orders_with_customer(cat.with_table("fct_orders", batch)),
                     scratch_path(spark, "late-ckpt"), "ordered_at", "60 days", files_per_batch=1)
    return target.read().select(*IM.J15_COLUMNS)
