import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlet.operators.incremental import (
    SchemaChangeError, after_per_key_mark, per_key_marks, align_schema, dedupe_latest, high_water_mark, mark_condition, merge_rows)
from martlet.session import scratch_path
from martlet.sources.sinks import Layout
from martlet.sources.target import IncrementalConfig, Target

SCHEMA = "order_id long, amount double, ordered_at timestamp_ntz"


def ts(d, h=0):
    return dt.datetime(2024, 1, d, h)


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _cfg(**kw):
    base = dict(layout=Layout(partition_field="ordered_at", partition_kind="day"),
                unique_key=("order_id",), strategy="merge")
    base.update(kw)
    return IncrementalConfig(**base)


def _rows(target):
    return sorted((r.order_id, r.amount, r.ordered_at) for r in
                  target.read().select("order_id", "amount", "ordered_at").collect())


def test_mark_on_empty_target_selects_nothing_without_default(spark):
    df = _df(spark, [(1, 1.0, ts(1))])
    empty = df.limit(0)
    assert df.where(mark_condition("ordered_at", high_water_mark(empty, "ordered_at"))).count() == 0
    mark = high_water_mark(empty, "ordered_at", dt.datetime(1900, 1, 1))
    assert df.where(mark_condition("ordered_at", mark)).count() == 1


def test_mark_variants(spark):
    df = _df(spark, [(1, 1.0, ts(5)), (2, 1.0, ts(8)), (3, 1.0, ts(10)), (4, 1.0, ts(3))])
    mark = ts(8)
    ids = lambda c: sorted(r.order_id for r in df.where(c).collect())
    assert ids(mark_condition("ordered_at", mark)) == [3]
    assert ids(mark_condition("ordered_at", mark, inclusive=True)) == [2, 3]
    # 3-day look-back: row 2 days late is picked up, row 5 days late is not
    assert ids(mark_condition("ordered_at", mark, lookback_days=3)) == [1, 2, 3]


def test_dedupe_latest_and_delete_insert(spark):
    batch = _df(spark, [(1, 1.0, ts(1)), (1, 2.0, ts(2)), (2, 5.0, ts(1))])
    d = sorted((r.order_id, r.amount) for r in dedupe_latest(batch, ["order_id"], ["ordered_at"]).collect())
    assert d == [(1, 2.0), (2, 5.0)]
    existing = _df(spark, [(1, 0.5, ts(1)), (3, 3.0, ts(1))])
    m = sorted((r.order_id, r.amount) for r in merge_rows(existing, batch, ["order_id"]).collect())
    assert m == [(1, 1.0), (1, 2.0), (2, 5.0), (3, 3.0)]   # delete+insert keeps both batch rows


def test_schema_change_modes(spark):
    old = _df(spark, [(1, 1.0, ts(1))]).withColumn("legacy", F.lit(1))
    new = _df(spark, [(2, 2.0, ts(2))]).withColumn("extra", F.lit("x"))
    with pytest.raises(SchemaChangeError):
        align_schema(old, new, "fail")
    e, b = align_schema(old, new, "sync_all_columns")
    assert e.columns == b.columns == ["order_id", "amount", "ordered_at", "extra"]
    e, b = align_schema(old, new, "append_new_columns")
    assert e.columns == b.columns == ["order_id", "amount", "ordered_at", "legacy", "extra"]
    e, b = align_schema(old, new, "ignore")
    assert b.columns == e.columns


def test_target_merge_moves_key_and_drops_emptied_partition(spark):
    t = Target(spark, scratch_path(spark, "t-merge"), _cfg())
    assert not t.is_incremental()
    t.apply(_df(spark, [(1, 1.0, ts(1)), (2, 2.0, ts(2))]))
    assert t.is_incremental()
    # order 1 moves from day 1 to day 3: day 1 becomes empty and must vanish
    t.apply(_df(spark, [(1, 1.5, ts(3))]))
    assert _rows(t) == [(1, 1.5, ts(3)), (2, 2.0, ts(2))]
    # replay is idempotent
    t.apply(_df(spark, [(1, 1.5, ts(3))]))
    assert _rows(t) == [(1, 1.5, ts(3)), (2, 2.0, ts(2))]


def test_target_insert_overwrite_replaces_whole_partitions(spark):
    t = Target(spark, scratch_path(spark, "t-io"), _cfg(strategy="insert_overwrite"))
    t.apply(_df(spark, [(1, 1.0, ts(1)), (2, 2.0, ts(1)), (3, 3.0, ts(2))]))
    t.apply(_df(spark, [(9, 9.0, ts(1, 5))]))
    assert _rows(t) == [(3, 3.0, ts(2)), (9, 9.0, ts(1, 5))]


def test_target_append_and_schema_fail(spark):
    t = Target(spark, scratch_path(spark, "t-app"), _cfg(strategy="append", on_schema_change="fail"))
    t.apply(_df(spark, [(1, 1.0, ts(1))]))
    t.apply(_df(spark, [(1, 1.0, ts(1))]))
    assert len(_rows(t)) == 2
    with pytest.raises(SchemaChangeError):
        t.apply(_df(spark, [(2, 1.0, ts(2))]).withColumn("extra", F.lit(1)))


def test_target_empty_first_load(spark):
    t = Target(spark, scratch_path(spark, "t-empty"), _cfg())
    t.load_full(_df(spark, []))
    assert t.exists() and t.read() is None
    t.apply(_df(spark, [(1, 1.0, ts(1))]))
    assert _rows(t) == [(1, 1.0, ts(1))]


def test_full_refresh_versions_and_retention(spark):
    from martlet.sources.sinks import committed_versions, full_refresh, read_table
    root = scratch_path(spark, "t-versions")
    for i in range(4):
        full_refresh(_df(spark, [(i, float(i), ts(1))]), root)
    assert committed_versions(spark, root) == [3, 4]
    assert [r.order_id for r in read_table(spark, root).collect()] == [3]


def test_merge_restricted_to_batch_partitions(spark):
    t = Target(spark, scratch_path(spark, "t-fixed"), _cfg(keys_move_partitions=False))
    t.apply(_df(spark, [(1, 1.0, ts(1)), (2, 2.0, ts(2))]))
    t.apply(_df(spark, [(2, 2.5, ts(2)), (3, 3.0, ts(3))]))
    assert _rows(t) == [(1, 1.0, ts(1)), (2, 2.5, ts(2)), (3, 3.0, ts(3))]


def test_mark_reads_only_the_newest_partition(spark):
    t = Target(spark, scratch_path(spark, "t-mark"), _cfg())
    assert t.mark("ordered_at") is None
    assert t.mark("ordered_at", ts(1)) == ts(1)
    t.apply(_df(spark, [(1, 1.0, ts(1, 5)), (2, 2.0, ts(9, 7)), (3, 3.0, ts(9, 2))]))
    assert t.mark("ordered_at") == ts(9, 7)
    assert t.mark("amount") == 3.0                      # not the partition field: full scan
    monthly = Target(spark, scratch_path(spark, "t-mark-m"),
                     _cfg(layout=Layout(partition_field="ordered_at", partition_kind="month")))
    monthly.apply(_df(spark, [(1, 1.0, ts(1)), (2, 2.0, ts(20, 3))]))
    assert monthly.mark("ordered_at") == ts(20, 3)


def test_null_keys_have_a_mark(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 1)], "k string, t int")
    marks = per_key_marks(rows, ["k"], "t")
    assert after_per_key_mark(rows, marks, ["k"], "t").count() == 0
    assert after_per_key_mark(rows.withColumn("t", F.lit(2)), marks, ["k"], "t").count() == 2


def test_merge_refuses_duplicate_keys(spark):
    t = Target(spark, scratch_path(spark, "t-dup"), _cfg())
    t.load_full(_df(spark, [(1, 1.0, ts(1))]))
    with pytest.raises(ValueError, match="several rows"):
        t.apply(_df(spark, [(1, 2.0, ts(2)), (1, 3.0, ts(2))]))
    assert t.read().count() == 1


def test_defaults_are_the_models_own():
    from martlet.plans.params import Params
    p = Params()
    assert (p.price_min, p.spend_min, p.as_of, p.user) == (20.0, 500.0, None, None)
