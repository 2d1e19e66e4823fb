"""Versioned targets: broken runs, schema drift, merges that replace files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlet.operators.incremental import SchemaChangeError, widens
from martlet.session import scratch_path
from martlet.sources.sinks import Layout, committed_versions
from martlet.sources.target import IncrementalConfig, Target


def ts(d):
    return dt.datetime(2024, 1, d)


def frame(spark, rows, ddl="k long, v double, at timestamp_ntz"):
    return spark.createDataFrame(rows, ddl)


def target(spark, **kw):
    base = dict(layout=Layout(partition_field="at", partition_kind="day"), unique_key=("k",), on_schema_change="sync_all_columns")
    return Target(spark, scratch_path(spark, "versions"), IncrementalConfig(**(base | kw)))


def rows(t, *columns):
    return sorted((tuple(r) for r in t.read().select(*(columns or ("k", "v", "at"))).collect()), key=str)


@pytest.mark.parametrize("step", ["apply", "load_full"])
def test_a_run_that_dies_before_its_commit_changes_nothing(spark, monkeypatch, step):
    t = target(spark)
    t.load_full(frame(spark, [(1, 1.0, ts(1)), (2, 2.0, ts(2))]))
    before, reader = rows(t), t.read()
    change = frame(spark, [(1, 9.0, ts(3))])                          # moves key 1
    monkeypatch.setattr(t, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        getattr(t, step)(change)
    monkeypatch.undo()
    assert rows(t) == before and reader.count() == 2                  # files of the old version are all there
    getattr(t, step)(change)
    assert rows(t) == ([(1, 9.0, ts(3)), (2, 2.0, ts(2))] if step == "apply" else [(1, 9.0, ts(3))])
    assert reader.count() == 2                                        # a reader of the version before isn't disturbed
    for i in range(4):
        t.load_full(frame(spark, [(i, 0.0, ts(1))]))
    assert len(committed_versions(spark, t.path)) == 2 and len(t._children("data")) == 2


def test_dropped_columns_are_gone_and_stay_gone(spark):
    t = target(spark)
    t.load_full(frame(spark, [(1, 1.0, ts(1)), (2, 2.0, ts(2))]).withColumn("legacy", F.lit("old")))
    t.apply(frame(spark, [(2, 3.0, ts(2))]).withColumn("extra", F.lit(7)))
    assert t.read().columns == ["k", "v", "at", "extra", "at_day"]
    assert rows(t, "k", "extra") == [(1, None), (2, 7)]
    t.apply(frame(spark, [(3, 3.0, ts(3))]).withColumn("legacy", F.lit("new")))
    assert rows(t, "k", "legacy") == [(1, None), (2, None), (3, "new")] and "extra" not in t.read().columns
    assert t.mark("k") == 3 and t.mark("legacy") == "new"


def test_types_widen_or_are_refused(spark):
    t = target(spark)
    t.load_full(frame(spark, [(1, 5, ts(1)), (2, 6, ts(2))], "k long, v int, at timestamp_ntz"))
    t.apply(frame(spark, [(2, 2**40, ts(2))], "k long, v long, at timestamp_ntz"))
    assert rows(t, "k", "v") == [(1, 5), (2, 2**40)]
    t.apply(frame(spark, [(3, "x", ts(2))], "k long, v string, at timestamp_ntz"))
    assert rows(t, "k", "v") == [(1, "5"), (2, str(2**40)), (3, "x")]
    with pytest.raises(SchemaChangeError, match="v"):
        t.apply(frame(spark, [(4, 1, ts(2))], "k long, v int, at timestamp_ntz"))
    assert t.read().count() == 3
    from pyspark.sql import types as T
    assert not widens(T.LongType(), T.DoubleType()) and widens(T.IntegerType(), T.DoubleType()) and widens(T.DateType(), T.TimestampNTZType())


def files(t):
    return {r[0] for r in t.read().select(F.input_file_name()).distinct().collect()}


@pytest.mark.parametrize("many", [False, True])
def test_a_merge_replaces_only_the_files_it_hits(spark, monkeypatch, many):
    from martlet.sources import target as module
    if many:
        monkeypatch.setattr(module, "LISTED_KEYS", 0)                 # by a join instead of a list of keys
    t = target(spark, layout=Layout(partition_field="at", partition_kind="month", cluster_by=("k",), num_parts=8), rewrite_files=True)
    first = [(i, float(i), dt.datetime(2024, 1 + i % 2, 3)) for i in range(400)]
    t.load_full(frame(spark, first))
    before = files(t)
    assert len(before) >= 8
    t.apply(frame(spark, [(10, -1.0, dt.datetime(2024, 1, 3)), (12, -2.0, dt.datetime(2024, 3, 1)), (999, 9.0, dt.datetime(2024, 3, 1))]))
    want = [r for r in first if r[0] not in (10, 12)] + [(10, -1.0, dt.datetime(2024, 1, 3)), (12, -2.0, dt.datetime(2024, 3, 1)), (999, 9.0, dt.datetime(2024, 3, 1))]
    assert rows(t) == sorted(want, key=str)
    assert len(before - files(t)) <= 2 and len(before & files(t)) >= 6        # keys 10 and 12 lie in one file, or in two neighbours
    t.apply(frame(spark, [(10, -5.0, dt.datetime(2024, 1, 3))]))
    t.apply(frame(spark, [(10, -5.0, dt.datetime(2024, 1, 3))]))
    assert (10, -5.0, dt.datetime(2024, 1, 3)) in rows(t) and t.read().count() == 401
    if not many:
        found = t._with_keys(t.read(), frame(spark, [(10, 0.0, ts(1))]), ["k"])
        assert "PushedFilters: [In(k, [10])]" in (p := found._jdf.queryExecution().executedPlan().toString()) or "EqualTo(k,10)" in p


def test_partition_values_with_signs(spark):
    t = Target(spark, scratch_path(spark, "versions"), IncrementalConfig(layout=Layout(partition_field="s", partition_kind="value"), unique_key=("k",), rewrite_files=True))
    t.load_full(spark.createDataFrame([(1, "a b/c:d%"), (2, None), (3, "x")], "k long, s string"))
    t.apply(spark.createDataFrame([(1, "x"), (2, "a b/c:d%")], "k long, s string"))
    assert rows(t, "k", "s") == [(1, "x"), (2, "a b/c:d%"), (3, "x")]
    whole = Target(spark, scratch_path(spark, "versions"), IncrementalConfig(layout=Layout(partition_field="s", partition_kind="value"), unique_key=("k",)))
    whole.load_full(spark.createDataFrame([(1, "a b/c:d%"), (2, None)], "k long, s string"))
    whole.apply(spark.createDataFrame([(1, None), (2, "a b/c:d%")], "k long, s string"))
    assert rows(whole, "k", "s") == [(1, None), (2, "a b/c:d%")]
