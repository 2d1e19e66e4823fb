import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from martlet.operators.ranking import rank_within


def _expected(df, keys, value, descending=True):
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    return df.withColumn("rank", F.rank().over(Window.partitionBy(*keys).orderBy(order)).cast("long"))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rank_matches_window_with_ties_and_hot_key(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(4000):
        k = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])   # one key holds a third
        v = float(rnd.randint(0, 40)) if i % 50 else None
        rows.append((k, v, i))
    df = spark.createDataFrame(rows, "k string, v double, id long")
    got = rank_within(df, ["k"], "v", "rank", num_partitions=7)
    assert _same(got, _expected(df, ["k"], "v"))


def test_rank_two_keys_ascending_many_parts(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 3), rnd.choice(["x", "y"]), rnd.randint(0, 9), i) for i in range(1500)]
    df = spark.createDataFrame(rows, "a int, b string, v int, id long")
    got = rank_within(df, ["a", "b"], "v", "rank", descending=False, num_partitions=13)
    assert _same(got, _expected(df, ["a", "b"], "v", descending=False))


def test_single_key_spread_over_every_part(spark):
    df = spark.range(3000).select(F.lit("m").alias("k"), (F.col("id") % 97).alias("v"), "id")
    got = rank_within(df, ["k"], "v", "rank", num_partitions=5)
    assert _same(got, _expected(df, ["k"], "v"))
    # v = id % 97 gives 30 or 31 rows per value; the smallest value ranks last
    assert got.where(F.col("v") == 0).select("rank").distinct().first()[0] == 3000 - 31 + 1


def test_rank_keeps_schema(spark):
    df = spark.createDataFrame([("m", 1.0, 1)], "k string, v double, id long")
    got = rank_within(df, ["k"], "v")
    assert got.columns == ["k", "v", "id", "rank"]
    assert dict(got.dtypes)["rank"] == "bigint"


def test_huge_tie_group_spreads_and_ranks_right(spark):
    # a third of the rows share one (key, value): they must span several parts
    rows = [("m", 5.0 if i % 3 == 0 else float(i % 11), i) for i in range(6000)]
    rows += [("n", None, i) for i in range(6000, 6100)] + [("n", 1.0, 7000)]
    df = spark.createDataFrame(rows, "k string, v double, id long")
    got = rank_within(df, ["k"], "v", "rank", num_partitions=9)
    assert _same(got, _expected(df, ["k"], "v"))
    asc = rank_within(df, ["k"], "v", "rank", descending=False, num_partitions=9)
    assert _same(asc, _expected(df, ["k"], "v", descending=False))


def test_longs_beside_nulls_are_kept(spark):
    big = 9007199254740993                                   # no double holds it
    df = spark.createDataFrame([("a", 1, big), ("a", 2, None), ("a", 2, big + 2)], "k string, v int, x long")
    got = sorted((r.v, r.x or 0, r.rank) for r in rank_within(df, ["k"], "v", "rank", num_partitions=3).collect())
    assert got == [(1, big, 3), (2, 0, 1), (2, big + 2, 1)]
