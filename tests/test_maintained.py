"""Maintained models: replays, late rows, corrections, crossings of the threshold, expiry, renamed customers, broken runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlet.plans import incremental_models as IM
from martlet.plans import maintained, orders as M
from martlet.plans.dimension_changes import changed_keys, propagate, row_hashes
from martlet.plans.maintained import Batch, HighValueItems, RecentProducts, Spend, TypeCounts
from martlet.plans.params import Params
from martlet.session import scratch_path
from martlet.sources.catalog import Catalog
from martlet.sources.delta_log import DeltaLog, LogSpec
from martlet.sources.sinks import path_exists
from martlet.sources.target import Target

ORDERS = "order_id long, customer_id long, order_total double, ordered_at timestamp_ntz"
ITEMS = "order_item_id string, order_id long, product_id long, product_price double, is_food_item int, is_drink_item int"
CUSTOMERS = "customer_id long, name string"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def catalog(spark, orders, items, customers=((1, "ann"), (2, "bob"), (3, "bob"))):
    tables = {"fct_orders": (orders, ORDERS), "order_items": (items, ITEMS), "dim_customers": (list(customers), CUSTOMERS)}
    return Catalog(spark, {k: (lambda v=v: spark.createDataFrame(*v)) for k, v in tables.items()})


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "order_id long")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def order(i, customer, total, n=0):
    return (i, customer, float(total), day(n))


def item(i, product, price, food=1, drink=0, line=0):
    return (f"{i}-{line}", i, product, float(price), food, drink)


def test_spend_merges_late_batches_and_ignores_replays(spark):
    state = Spend(spark, scratch_path(spark, "t"), 2)
    every = [order(1, 1, 10), order(2, 2, 5, 3), order(3, 9, 7), order(4, None, 2), order(5, 1, 4, -5)]
    first, second = Batch("a", catalog(spark, every[:2], [])), Batch("b/2", catalog(spark, every[2:4], []))
    late = Batch("late", catalog(spark, every[4:], []))
    assert state.apply(first) and state.apply(second) and not state.apply(second)
    state.log.compact()
    assert not state.apply(first) and state.apply(late) and state.apply(Batch("none", catalog(spark, [], [])))
    whole = catalog(spark, every, [])
    assert rows(state.by_name(whole.table("dim_customers"))) == rows(M.spend_per_customer_name(whole))
    assert rows(state.with_last_order(whole.table("dim_customers"))) == rows(M.spend_and_last_order(whole))
    totals = [r.total_spent for r in state.by_name(whole.table("dim_customers")).collect()]
    assert totals == sorted(totals, reverse=True)


def test_counts_are_taken_back(spark):
    state = TypeCounts(spark, scratch_path(spark, "t"), 2)
    state.apply(Batch("a", catalog(spark, [order(1, 1, 1), order(2, 2, 1), order(3, 3, 1)], [item(1, 7, 1), item(1, 8, 1, 1, 1, 1), item(2, 7, 1, 0, 1), item(3, 7, 1)])))
    fixed = Batch("b", catalog(spark, [order(1, 2, 1)], [item(1, 7, 1, 0, 1)]), ids(spark, 3, 99))    # moved, other items; deleted; never there
    assert state.apply(fixed) and not state.apply(fixed)
    whole = catalog(spark, [order(1, 2, 1), order(2, 2, 1)], [item(1, 7, 1, 0, 1), item(2, 7, 1, 0, 1)])
    assert rows(state.result(whole.table("dim_customers"))) == rows(M.item_type_counts(whole)) == [("bob", 2, "drink")]


def test_threshold_crossed_both_ways(spark):
    params = Params(price_min=20.0, spend_min=500.0)
    state = HighValueItems(spark, scratch_path(spark, "t"), params, 4)
    orders = {1: order(1, 1, 400), 2: order(2, 2, 501), 3: order(3, 3, 500)}
    items = {1: [item(1, 7, 30), item(1, 7, 30, line=1), item(1, 8, 20)], 2: [item(2, 7, 21)], 3: [item(3, 9, 99)]}

    def check():
        whole = catalog(spark, list(orders.values()), [x for v in items.values() for x in v])
        want = rows(M.expensive_items_of_high_value(whole, params))
        assert rows(state.result(whole.table("dim_customers"))) == want
        return want

    state.apply(Batch("a", catalog(spark, list(orders.values()), [x for v in items.values() for x in v])))
    assert check() == [("bob", 7, 21.0)]
    orders[4], items[4] = order(4, 1, 101), [item(4, 5, 50)]          # customer 1 rises
    up = Batch("b", catalog(spark, [orders[4]], items[4]))
    told = state.crossing(up, state.order_change(up))
    assert rows(told) == [(1, False, True)]
    plan = state.old_items_of_crossing(up, told)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "In(" not in plan.split("PartitionFilters")[0][-5:]
    assert {r.customer_id for r in state.old_items_of_crossing(up, told).collect()} == {1}
    assert state.apply(up) and not state.apply(up)
    assert len(check()) == 4
    del orders[1], items[1]                                           # customer 1 falls, and 2's order is booked on 3
    orders[2] = order(2, 3, 600)
    state.apply(Batch("c", catalog(spark, [orders[2]], items[2]), ids(spark, 1)))
    assert check() == [("bob", 7, 21.0), ("bob", 9, 99.0)]


def test_window_moves_on(spark):
    state = RecentProducts(spark, scratch_path(spark, "t"), days=10)
    every = [order(i, 1, 1, i) for i in range(1, 25)]
    bought = [item(i, i % 3, 5) for i in range(1, 25)] + [item(i, i % 3, 5, line=1) for i in range(1, 25)]

    def batch(name, lo, hi, removed=None):
        return Batch(name, catalog(spark, every[lo - 1:hi], [x for x in bought if lo <= x[1] <= hi]), removed)

    state.apply(batch("a", 1, 12), day(12).date())
    state.apply(batch("b", 10, 18), day(18).date())                   # three days again
    assert not state.apply(batch("b", 10, 18), day(18).date())
    assert state.apply(batch("c", 19, 24, ids(spark, 17)), day(24).date())
    want = sorted((i % 3, 5.0, day(i)) for i in range(14, 25) if i != 17)
    assert sorted(tuple(r) for r in state.result(day(24).date()).collect()) == want
    assert state.log.read().agg(F.min("order_day")).first()[0] == day(14).date()     # older days left the state, not just the result


def test_a_broken_run_is_repeated_without_harm(spark, monkeypatch):
    state = TypeCounts(spark, scratch_path(spark, "t"), 2)
    state.apply(Batch("a", catalog(spark, [order(1, 1, 1)], [item(1, 7, 1)])))
    change = Batch("b", catalog(spark, [order(1, 2, 1)], [item(1, 7, 1), item(1, 8, 1, line=1)]))
    monkeypatch.setattr(state.orders, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        state.apply(change)                                           # one log has the batch, the other hasn't
    monkeypatch.undo()
    state.apply(change)
    state.apply(change)
    whole = catalog(spark, [order(1, 2, 1)], [item(1, 7, 1), item(1, 8, 1, line=1)])
    assert rows(state.result(whole.table("dim_customers"))) == rows(M.item_type_counts(whole))


def test_log_compacts_in_any_state(spark, monkeypatch):
    spec = LogSpec("k long", "v double", "at date", bucket_by="k", buckets=2, compact_after=3)
    log = DeltaLog(spark, scratch_path(spark, "t"), spec)

    def change(*values):
        return spark.createDataFrame([(k, v, dt.date(2024, 1, d), n) for k, v, d, n in values], "k long, v double, at date, n long")

    assert log.state().count() == 0 and log.read().columns == ["k", "v", "n", "at", "bucket"]
    for i, rows_ in enumerate([[(1, 2.0, 3, 1), (2, 1.0, 1, 1)], [(1, 1.0, 2, 1)], [(2, -1.0, 1, -1), (None, 5.0, 4, 1)], [(1, 4.0, 9, 1)], []]):
        assert log.append(change(*rows_), i) and not log.append(change(*rows_), i)
    want = [(1, 7.0, 3, dt.date(2024, 1, 9)), (None, 5.0, 1, dt.date(2024, 1, 4))]
    assert rows(log.state().select("k", "v", "n", "at")) == want
    data = log._write
    monkeypatch.setattr(log, "_write", lambda df, path: (data(df, path), (_ for _ in ()).throw(RuntimeError("lost"))))
    with pytest.raises(RuntimeError):
        log.compact()                                                 # data is there, the list of what it covers isn't
    monkeypatch.undo()
    assert rows(log.state().select("k", "v", "n", "at")) == want
    log.compact()
    log.compact()
    assert rows(log.state().select("k", "v", "n", "at")) == want
    assert rows(log.touching(spark.createDataFrame([(None,), (5,)], "k long"), ["k"]).select("k", "v")) == [(None, 5.0)]
    with pytest.raises(ValueError):
        log.read(without=0)
    assert not log.append(change((1, 1.0, 1, 1)), 0)


def test_renamed_customers_rewrite_only_their_months(spark):
    root = scratch_path(spark, "t")
    target = Target(spark, f"{root}/orders", IM.ORDERS_WITH_CUSTOMER_BY_MONTH)
    orders = [order(1, 1, 1, 0), order(2, 2, 1, 0), order(3, 2, 1, 40), order(4, 3, 1, 80), order(5, 4, 1, 120), order(6, None, 1, 120)]
    cat = catalog(spark, orders, [])
    IM.refresh_orders_with_customer(cat, target)
    take = {"name": "customer_name"}
    dim = cat.table("dim_customers")
    assert propagate(target, dim, f"{root}/dim", "customer_id", take) == []
    assert propagate(target, dim, f"{root}/dim", "customer_id", take) == []

    def files():
        return {tuple(r) for r in target.read().select("ordered_at_month", F.input_file_name()).distinct().collect()}

    new = spark.createDataFrame([(1, "ann"), (2, "rob"), (4, "dan"), (None, "x")], CUSTOMERS)       # renamed, gone (3), came late (4)
    moved = propagate(target, new, f"{root}/dim", "customer_id", take)
    assert moved == [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1), dt.date(2024, 4, 1)]
    want = [(1, "ann"), (2, "rob"), (3, "rob"), (4, None), (5, "dan"), (6, None)]
    assert rows(target.read().select("order_id", "customer_name")) == want
    again = spark.createDataFrame([(1, "ann"), (2, "rob"), (4, "Dan")], CUSTOMERS)
    before = files()
    assert propagate(target, again, f"{root}/dim", "customer_id", take) == [dt.date(2024, 4, 1)]
    assert {month for month, _ in before ^ files()} == {dt.date(2024, 4, 1)}
    assert rows(changed_keys(again, row_hashes(again, "customer_id", ["name"]), "customer_id", ["name"])) == []


def test_type_counts_do_not_move_item_ids(spark, tmp_path):
    from martlet.plans.queries_maintained import _corrected
    from martlet.sources.catalog import fixture_catalog
    tables = {"lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int", [(1, 1, 1, 1), (1, 2, 1, 2), (2, 3, 1, 1)]),
              "part": ("p_partkey long, p_type string, p_retailprice double", [(1, "LARGE", 1.0), (2, "STANDARD", 2.0), (3, "MEDIUM", 3.0)]),
              "orders": ("o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz", [(1, 1, 3.0, day(0)), (2, 1, 3.0, day(0))])}
    for name, (ddl, rows) in tables.items():
        spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / f"{name}.parquet"))
    cat = fixture_catalog(spark, str(tmp_path))
    assert [tuple(r) for r in M._type_counts_per_order(cat).collect()] == [(1, 2, 2, 1, 1)]
    for batch in _corrected(cat)[1:3]:
        plan = M._type_counts_per_order(batch.rows)._jdf.queryExecution().executedPlan().toString()
        assert "l_orderkey" in plan and "l_suppkey" not in plan and "l_linenumber" not in plan


def test_type_counts_leave_out_items_without_id(spark):
    cat = catalog(spark, [], [("a", 1, 1, 1.0, 1, 1), (None, 1, 1, 1.0, 1, 0), (None, 2, 1, 1.0, 0, 1), ("b", 2, 1, 1.0, None, 0), (None, None, 1, 1.0, 1, None)])
    got = {tuple(r) for r in M._type_counts_per_order(cat).collect()}
    assert got == {(1, 1, 2, 1, 1), (2, 0, 0, 0, 1), (None, 0, 1, 0, 0)}
