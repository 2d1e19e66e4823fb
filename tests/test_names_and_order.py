"""Names that are found or refused, sorted results, dates that are none, hot keys."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from martlet.operators import joins as J
from martlet.plans import sales_plan as SP
from martlet.sources.catalog import Catalog, fixture_catalog, name_parts
from martlet.sources.sinks import Layout, switched_layout

SF = "/root/testdata/sf0.001"


def test_names(spark):
    one = lambda v: (lambda: spark.createDataFrame([(v,)], "v string"))
    cat = Catalog(spark, {"a.x.t": one("axt"), "b.y.t": one("byt"), "u": one("u"), "x.u": one("xu"), "`p.q`.z": one("z")})
    got = lambda n: cat.table(n).first().v
    assert (got("a.x.t"), got("y.t"), got("any.x.u"), got("any.w.u"), got("u"), got("z"), got("`p.q`.z")) == ("axt", "byt", "xu", "u", "u", "z", "z")
    for unknown in ("t", "c.x.t", "v", "p.q.z.z"):
        with pytest.raises(KeyError):
            cat.table(unknown)
    assert name_parts("`a.b`.c.`d`") == ("a.b", "c", "d")
    cat.declare_source("s", {"t": "a.x.t"})
    cat.declare_source("r", {"t": "b.y.t"})
    assert cat.source("s", "t").first().v == "axt" and cat.with_table("new", spark.range(1)).source("r", "t").first().v == "byt"
    with pytest.raises(KeyError):
        cat.source("q", "t")


def test_switched_layout():
    choices = (("p", False, {"partition_field": "d", "partition_kind": "date"}), ("c", True, {"cluster_by": ("k",)}))
    assert switched_layout({}, *choices) == Layout(cluster_by=("k",))
    assert switched_layout({"p": True, "c": False}, *choices) == Layout(partition_field="d", partition_kind="date")


@pytest.mark.parametrize("key, order", [("j02_spend_per_customer", [("total_spent", True)]), ("j09_spend_and_last_order", [("total_spent", True)]),
                                        ("j08_email_activity_analyst", [(c, False) for c in ("prod_nm", "terr_id", "year", "mes")])])
def test_results_come_sorted(spark, key, order):
    rows = E.queries()[key](spark, SF).collect()
    told = [tuple(-r[c] if down else r[c] for c, down in order) for r in rows]
    assert len(told) > 5 and told == sorted(told)


def test_a_date_that_is_none_raises(spark):
    cat = fixture_catalog(spark, SF)
    plan = cat.table("stg_mccp_prod_plan")
    bad = cat.with_table("stg_mccp_prod_plan", plan.withColumn("modified_date", F.when(F.col("systemmodstamp") == plan.agg(F.max("systemmodstamp")).first()[0], "2024-13-01").otherwise(F.col("modified_date"))))
    with pytest.raises(Exception, match="modified_date is no date: 2024-13-01"):
        SP.sales_call_plan(bad).collect()
    empty = cat.with_table("stg_mccp_prod_plan", plan.withColumn("modified_date", F.lit(None).cast("string")))
    assert SP.sales_call_plan(empty).count() == SP.sales_call_plan(cat).count()


def test_hot_keys_are_counted_exactly(spark):
    flat = spark.range(10_000).select((F.col("id") % 700).alias("k"))
    assert J.hot_keys(flat, "k", 0.01) == []
    skewed = flat.unionByName(spark.range(300).select(F.lit(5).cast("long").alias("k")))
    assert J.hot_keys(skewed, "k", 0.02) == [5]
    assert J.hot_keys(flat.limit(0), "k", 0.01) == []


def test_hot_rows_are_spread_and_joined_once(spark):
    facts = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).cast("long").alias("k"))
    dim = spark.range(5000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = J.skew_split_lookup(facts, dim, "k", {"name": "who"})
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1
        assert got.exceptAll(J.lookup(facts, dim, "k", {"name": "who"}).select(*got.columns)).count() == 0 and got.count() == 9000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
