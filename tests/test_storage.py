"""Clustering curves, footers, bucketed tables and the strict lookup: what the files and plans must show."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from martlet.operators import joins as J
from martlet.operators.clustering import interleaved, quantiles, rank_among
from martlet.session import scratch_path
from martlet.sources.bucketed import BucketedTable, join_bucketed
from martlet.sources.footers import footer_max, stored_max
from martlet.sources.sinks import Layout, parts_for, write_parquet


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def groups(path, column):
    """(least, greatest) of a column in each row group, from the footers."""
    out = []
    for f in glob.glob(f"{path.replace('file:', '')}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.to_arrow_schema().get_field_index(column)
        out += [(s.min, s.max) for i in range(meta.num_row_groups) if (s := meta.row_group(i).column(at).statistics).has_min_max]
    return out


@pytest.mark.parametrize("second", ["b", "name"])
def test_curve_lets_filters_on_each_column_skip_row_groups(spark, second):
    rows = spark.range(20_000).select((F.xxhash64("id") % 1000).alias("a"), F.pow(F.abs(F.hash("id") % 1000) / 100, F.lit(4)).alias("b"),
                                      F.concat(F.lit("Customer#"), F.lpad((F.abs(F.hash("id", F.lit(1))) % 5000).cast("string"), 9, "0")).alias("name"))
    hit = {}
    for curve in (False, True):
        path = scratch_path(spark, "curve")
        write_parquet(rows, path, Layout(cluster_by=("a", second), curve=curve, num_parts=64))
        assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, rows.collect()))
        for column in ("a", second):
            wanted = rows.select(F.expr(f"percentile_disc(0.4) within group (order by {column})")).first()[0] if column != "name" else "Customer#000002000"
            found = groups(path, column)
            assert len(found) >= 60
            hit[curve, column] = sum(lo <= wanted <= hi for lo, hi in found) / len(found)
    assert hit[False, second] > 0.9                   # one after the other: the second column skips next to nothing
    assert hit[True, second] < 0.3 and hit[True, "a"] < 0.3


def test_curve_key_parts(spark):
    df = spark.createDataFrame([(1, None, "é"), (2, dt.date(2024, 1, 1), "b"), (None, dt.date(2024, 1, 2), "a" * 100), (2, dt.date(2024, 1, 3), None)], "k int, d date, s string")
    cuts = quantiles(df, ["k", "d", "s"], 2)
    assert all(v == sorted(set(v)) for v in cuts.values()) and quantiles(df.limit(0), ["k", "s"], 2) == {"k": [], "s": []}
    got = df.select(rank_among("k", [1, 2, 5], df.schema["k"].dataType, 2), rank_among("s", ["b", "c"], df.schema["s"].dataType, 2)).collect()
    assert [tuple(r) for r in got] == [(1, 2), (2, 1), (0, 0), (2, 0)]
    assert spark.range(1).select(interleaved([F.lit(5), F.lit(3)], 3)).first()[0] == 0b100111
    write_parquet(df.limit(0), scratch_path(spark, "curve"), Layout(cluster_by=("k", "s"), curve=True))


def test_parts_follow_the_data(spark):
    def files(df, **kw):
        path = scratch_path(spark, "parts")
        write_parquet(df, path, Layout(**kw))
        return len(glob.glob(f"{path.replace('file:', '')}/**/*.parquet", recursive=True))
    small = spark.range(100).withColumn("v", F.col("id") % 3)
    assert files(small, cluster_by=("id",)) == 1 and files(small, even=True, sort_by=("v",)) == 1
    assert files(small, cluster_by=("id",), num_parts=4) == 4
    stored = scratch_path(spark, "parts")
    spark.range(400_000).select(F.xxhash64("id").alias("h")).write.parquet(stored)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "256k")                       # about 3.2 MB of input
    assert 9 <= parts_for(spark.read.parquet(stored), False)[0] <= 16
    spark.conf.set(key, old)
    assert parts_for(small, True) == [4] and parts_for(small, False) == []


def test_maximum_from_footers(spark):
    at = [dt.datetime(2024, 1, d, 3, 4, 5, 678901) for d in (1, 9, 4)]
    rows = [(i, at[i % 3] if i % 5 else None, dt.date(2024, 2, 1 + i % 20), float(i) - 3, f"t{i}", None) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, at timestamp_ntz, d date, v double, s string, gone long").repartition(3)
    path = scratch_path(spark, "footers")
    df.write.parquet(path)
    for c in ("k", "at", "d", "v"):
        text = footer_max(spark, [path], c)
        assert f"PushedAggregation: [MAX({c})]" in text._jdf.queryExecution().executedPlan().toString()
        unit = 1_000_000 if c == "at" else 1
        assert c == "at" or text.first()[0] == df.agg(F.max(c)).first()[0]
        assert c != "at" or text.first()[0] // unit == int(at[1].replace(tzinfo=dt.timezone.utc).timestamp())
        assert stored_max(spark, path, c) == df.agg(F.max(c)).first()[0]
    assert stored_max(spark, path, "s") == "t99" and stored_max(spark, path, "gone") is None
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    df.select("v", "at", "k", "gone").where("k < 7").withColumn("k", F.col("k") + 1000).write.mode("append").parquet(path)      # other columns and order
    assert stored_max(spark, path, "k") == 1006 and stored_max(spark, path, "at") == at[1]
    some = scratch_path(spark, "footers")
    df.where("k < 50").write.option("parquet.column.statistics.enabled", "false").parquet(some)
    assert stored_max(spark, some, "k") == 49 and stored_max(spark, some, "at") == at[1]
    df.limit(0).write.parquet(empty := scratch_path(spark, "footers"))
    assert stored_max(spark, empty, "k") is None and stored_max(spark, empty, "at") is None


def test_footers_of_another_writer(spark, tmp_path):
    """Milliseconds are not taken for microseconds."""
    import pyarrow as pa
    at = [dt.datetime(2024, 1, 1), dt.datetime(2024, 5, 1)]
    pq.write_table(pa.table({"at": pa.array(at, pa.timestamp("ms"))}), tmp_path / "x.parquet")
    assert stored_max(spark, str(tmp_path / "x.parquet"), "at") == at[1]


def test_bucketed_join_has_no_exchange(spark, no_broadcast):
    n = 20_000
    facts = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("long").alias("k")).unionByName(
        spark.createDataFrame([(-1, None)], "id long, k long"))
    dims = spark.range(0, 400).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    a = BucketedTable(spark, "facts_by_k", scratch_path(spark, "bucketed"), "k", 8)
    b = BucketedTable(spark, "dims_by_k", scratch_path(spark, "bucketed"), "k", 8)
    a.save(facts, ("id",))
    b.save(dims)
    assert a.hot_keys() == [7] and b.hot_keys() == [] and a.read().count() == n + 1
    cold = plan(a.cold().join(b.cold(), "k"))
    assert "SortMergeJoin" in cold and "Exchange" not in cold and "SelectedBucketsCount: 8 out of 8" in cold
    got, want = join_bucketed(a, b), facts.join(dims, "k")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    assert a.cold().where("k = 7").count() == 0
    with pytest.raises(ValueError):
        join_bucketed(a, BucketedTable(spark, "x", "y", "k", 4))


def test_strict_lookup_raises_only_for_keys_asked_for(spark, no_broadcast):
    fact = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 99)], "id long, k long")
    dim = spark.createDataFrame([(10, "a"), (11, None), (12, "x"), (12, "y"), (None, "n"), (None, "m")], "k long, name string")
    got = J.strict_lookup(fact, dim, "k", "name", "who")
    assert "NestedLoop" not in plan(got)
    assert sorted(map(tuple, got.collect())) == [(1, 10, "a"), (2, 11, None), (3, None, None), (4, 99, None)]
    asked = fact.unionByName(spark.createDataFrame([(5, 12)], "id long, k long"))
    with pytest.raises(Exception, match="more than one row"):
        J.strict_lookup(asked, dim, "k", "name", "who").collect()
