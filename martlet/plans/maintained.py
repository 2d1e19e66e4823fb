"""Order models kept up to date by changes instead of rebuilt: J2, J4, J5 and J16.

Each model owns one or more ``DeltaLog`` states below its folder. A batch is the order rows that are new
or changed, all items of those orders, and the ids of orders that are gone; a batch id makes it idempotent.
The change of the model is worked out from the change of its inputs:

* ``Spend`` (J2, J9): sums, counts and the latest time merge, so new orders are added to partial states;
* ``TypeCounts`` (J4): an order's old counts are taken back before its new ones are added;
* ``HighValueItems`` (J5, J12): changed items of customers over the threshold, plus the old items of
  customers that crossed it, added or taken back; no other old item is read;
* ``RecentProducts`` (J16): counted DISTINCT over a window whose partitions expire.

All joins are on keys of the batch. Logs are partitioned by hash bucket and sorted by key, and only the
buckets of the batch are read, so the work of a batch grows with the batch.
"""

from __future__ import annotations

import contextlib
import dataclasses
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.joins import lookup
from martlet.plans.orders import MONEY, _type_counts_per_order, _type_counts_unpivot
from martlet.plans.params import Params
from martlet.session import scratch_path
from martlet.sources.catalog import Catalog
from martlet.sources.delta_log import N, DeltaLog, LogSpec, negated
from martlet.sources.sinks import delete_path

COUNTS = ["food_count", "food_rows", "drink_count", "drink_rows"]
_COUNTS = ", ".join(f"{c} long" for c in COUNTS)


@dataclass(frozen=True)
class Batch:
    """Changed orders with all their items (a catalog of just these), and ids of orders that are gone."""
    id: str
    rows: Catalog
    removed: DataFrame | None = None

    def orders(self, *columns: str) -> DataFrame:
        return self.rows.table("fct_orders").select(*columns)

    def touched(self) -> DataFrame:
        """Ids of all orders whose old version no longer holds."""
        ids = self.orders("order_id")
        return ids if self.removed is None else ids.unionByName(self.removed.select("order_id"))


def batch_of(cat: Catalog, id: str, condition, removed: DataFrame | None = None) -> Batch:
    """The orders under ``condition`` with their items as one batch."""
    orders = cat.table("fct_orders").where(condition)
    items = cat.table("order_items").join(orders.select("order_id"), "order_id", "left_semi")
    return Batch(id, cat.with_table("fct_orders", orders).with_table("order_items", items), removed)


@contextlib.contextmanager
def staged(spark: SparkSession):
    """A function that stores a frame in the shared folder, so that the jobs of one batch work it out once."""
    paths = []

    def store(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_path(spark, name))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield store
    finally:
        for path in paths:
            delete_path(spark, path)


def _log(spark: SparkSession, path: str, spec: LogSpec, buckets: int) -> DeltaLog:
    return DeltaLog(spark, path, dataclasses.replace(spec, buckets=buckets))


#: Hash buckets of a log; fixed for its life, so chosen for the size it will reach.
BUCKETS = 256


class Spend:
    """Orders per customer as mergeable partial states (sum, count, latest).

    Batches hold new orders, in any order of time: a late batch merges like any other. A maximum can't be taken
    back, so changed orders are not for this state.
    """
    SPEC = LogSpec("customer_id long", "spent double", "last_order timestamp_ntz", bucket_by="customer_id")

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.log = _log(spark, path, self.SPEC, buckets)

    def apply(self, batch: Batch) -> bool:
        orders = batch.orders("customer_id", "order_total", "ordered_at")
        return self.log.append(orders.groupBy("customer_id").agg(
            F.sum("order_total").alias("spent"), F.max("ordered_at").alias("last_order"), F.count(F.lit(1)).alias(N)), batch.id)

    def by_name(self, customers: DataFrame) -> DataFrame:
        """J2."""
        named = lookup(self.log.state(), customers, "customer_id", {"name": "customer_name"}, "left")
        return (named.groupBy("customer_name").agg(F.round(F.sum("spent"), MONEY).alias("total_spent"))
                .orderBy(F.col("total_spent").desc()))

    def with_last_order(self, customers: DataFrame) -> DataFrame:
        """Known customers with their latest order."""
        return (lookup(self.log.state(), customers, "customer_id", {"name": "customer_name"}, "inner")
                .select("customer_name", F.round("spent", MONEY).alias("total_spent"), F.col("last_order").alias("last_order_date"))
                .orderBy(F.col("total_spent").desc()))


class TypeCounts:
    """Item counts per customer and type; a changed, moved or deleted order takes its counts back."""
    ORDERS = LogSpec("order_id long, customer_id long", _COUNTS, bucket_by="order_id")
    CUSTOMERS = LogSpec("customer_id long", _COUNTS, bucket_by="customer_id")

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark = spark
        self.orders = _log(spark, f"{path}/orders", self.ORDERS, buckets)
        self.customers = _log(spark, f"{path}/customers", self.CUSTOMERS, buckets)

    def _change(self, batch: Batch) -> DataFrame:
        """(order_id, customer_id, counts, n): new versions, and old ones taken back."""
        new = (_type_counts_per_order(batch.rows).join(batch.orders("order_id", "customer_id"), "order_id")
               .withColumn(N, F.lit(1).cast("long")))
        old = negated(self.orders.touching(batch.touched(), ["order_id"], batch.id).drop("bucket"), self.ORDERS)
        return self.orders.fold(new.unionByName(old), ["order_id", "customer_id"], keep_zero=True)

    def apply(self, batch: Batch) -> bool:
        if self.customers.has(batch.id) and self.orders.has(batch.id):
            return False
        with staged(self.spark) as store:      # both logs get the same change: from the orders as they were before the batch
            change = store(self._change(batch), "count-change")
            self.customers.append(change.groupBy("customer_id").agg(*[F.sum(c).alias(c) for c in [*COUNTS, N]]), batch.id)
            self.orders.append(change, batch.id)
        return True

    def result(self, customers: DataFrame) -> DataFrame:
        per_name = (self.customers.state().join(customers.select("customer_id", "name"), "customer_id")
                    .groupBy("name").agg(*[F.sum(c).alias(c) for c in COUNTS]))
        return _type_counts_unpivot(per_name, ["name"])


class HighValueItems:
    """Items over ``price_min`` of customers whose orders sum up to more than ``spend_min``."""
    ORDERS = LogSpec("order_id long, customer_id long", "order_total double", bucket_by="order_id")
    SPEND = LogSpec("customer_id long", "order_total double", bucket_by="customer_id")
    ITEMS = LogSpec("customer_id long, order_id long, product_id long, product_price double", bucket_by="customer_id")
    RESULT = LogSpec("customer_id long, product_id long, product_price double", bucket_by="customer_id")

    def __init__(self, spark: SparkSession, path: str, params: Params, buckets: int = BUCKETS):
        self.spark, self.params = spark, params
        self.orders = _log(spark, f"{path}/orders", self.ORDERS, buckets)
        self.spend = _log(spark, f"{path}/spend", self.SPEND, buckets)
        self.items = _log(spark, f"{path}/items", self.ITEMS, buckets)
        self.rows = _log(spark, f"{path}/rows", self.RESULT, buckets)

    def order_change(self, batch: Batch) -> DataFrame:
        """(order_id, customer_id, order_total, n): new versions, and old ones taken back (n < 0)."""
        old = self.orders.touching(batch.touched(), ["order_id"], batch.id).drop("bucket")
        new = batch.orders("order_id", "customer_id", "order_total").withColumn(N, F.lit(1).cast("long"))
        return new.unionByName(negated(old, self.ORDERS))

    def item_change(self, batch: Batch, orders: DataFrame) -> DataFrame:
        """Changes of expensive items, given the changes of their orders."""
        new = (batch.rows.table("order_items").where(F.col("product_price") > self.params.price_min).select("order_id", "product_id", "product_price")
               .join(batch.orders("order_id", "customer_id"), "order_id").withColumn(N, F.lit(1).cast("long")))
        old = self.items.touching(orders.where(F.col(N) < 0), ["customer_id", "order_id"], batch.id).drop("bucket")
        return new.unionByName(negated(old, self.ITEMS))

    def crossing(self, batch: Batch, orders: DataFrame) -> DataFrame:
        """(customer_id, high_before, high_after) of the customers that the batch touches."""
        change = orders.groupBy("customer_id").agg(F.sum("order_total").alias("more"))
        before = self.spend.touching(change, ["customer_id"], batch.id).select("customer_id", "order_total")
        was = F.coalesce("order_total", F.lit(0.0))

        def high(x):
            return F.round(x, MONEY) > self.params.spend_min
        return (change.join(before, "customer_id", "left")
                .select("customer_id", high(was).alias("high_before"), high(was + F.coalesce("more", F.lit(0.0))).alias("high_after")))

    def old_items_of_crossing(self, batch: Batch, told: DataFrame) -> DataFrame:
        """Items before the batch of customers whose side of the threshold it changes, taken back where they fell."""
        moved = told.where("high_before <> high_after")
        old = self.items.touching(moved, ["customer_id"], batch.id).drop("bucket")
        return (old.join(moved.select("customer_id", "high_after"), "customer_id")
                .withColumn(N, F.when(F.col("high_after"), F.col(N)).otherwise(-F.col(N))).drop("high_after"))

    def apply(self, batch: Batch) -> bool:
        logs = (self.rows, self.items, self.spend, self.orders)
        if all(log.has(batch.id) for log in logs):
            return False
        with staged(self.spark) as store:      # all four logs get changes from the state before the batch
            orders = store(self.order_change(batch), "order-change")
            items = store(self.item_change(batch, orders), "item-change")
            told = store(self.crossing(batch, orders), "crossing")
            rows = items.join(told.where("high_after").select("customer_id"), "customer_id", "left_semi").unionByName(self.old_items_of_crossing(batch, told))
            for log, change in zip(logs, (rows, items, orders, orders)):
                log.append(log.fold(change, log.spec.names(log.spec.keys), keep_zero=True), batch.id)
        return True

    def result(self, customers: DataFrame) -> DataFrame:
        """J5, a row as often as it was bought."""
        kept = self.rows.state().withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(N))))
        return lookup(kept, customers, "customer_id", {"name": "name"}, "inner").select("name", "product_id", "product_price")


class RecentProducts:
    """J16 with a window that moves on: distinct (product, price, time) of the last ``days`` days.

    The state counts how often each order holds a row, by day. A row stays while its count is above zero; days that
    leave the window are dropped as whole partitions, so the state never holds more than the window.
    """
    SPEC = LogSpec("order_id long, product_id long, product_price double, ordered_at timestamp_ntz, order_day date", partition="order_day")

    def __init__(self, spark: SparkSession, path: str, days: int = 90):
        self.log, self.days = DeltaLog(spark, path, self.SPEC), days

    def _start(self, as_of: dt.date) -> dt.date:
        return as_of - dt.timedelta(days=self.days)

    def apply(self, batch: Batch, as_of: dt.date) -> bool:
        """Take in a batch, then let the days before the window of ``as_of`` go."""
        if self.log.has(batch.id):
            return False
        day = F.to_date("ordered_at")
        recent = batch.orders("order_id", "ordered_at").where((day >= F.lit(self._start(as_of))) & (day <= F.lit(as_of)))
        new = (batch.rows.table("order_items").select("order_id", "product_id", "product_price").join(recent, "order_id")
               .withColumn("order_day", day).withColumn(N, F.lit(1).cast("long")))
        old = negated(self.log.touching(batch.touched(), ["order_id"], batch.id), self.SPEC)
        self.log.append(self.log.fold(new.unionByName(old)), batch.id)
        self.log.expire(self._start(as_of))
        return True

    def result(self, as_of: dt.date) -> DataFrame:
        window = self.log.read().where((F.col("order_day") >= F.lit(self._start(as_of))) & (F.col("order_day") <= F.lit(as_of)))
        return (window.groupBy("product_id", "product_price", "ordered_at").agg(F.sum(N).alias(N))
                .where(F.col(N) > 0).drop(N))
