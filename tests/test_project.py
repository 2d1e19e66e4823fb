"""Building the project stores each model's rows exactly."""

from pyspark.sql import functions as F

from martlet.plans import email_activity as EM
from martlet.plans import orders as M
from martlet.plans import sales_plan as SP
from martlet.plans.params import Params
from martlet.plans.project import MODELS, read_model, run
from martlet.session import scratch_path
from martlet.sources.catalog import fixture_catalog

SF = "/root/testdata/sf0.001"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_run_builds_every_model_and_increments(spark):
    cat = fixture_catalog(spark, SF)
    root = scratch_path(spark, "project")
    first = cat.with_filter("fct_orders", F.col("ordered_at") < F.lit("2001-01-01").cast("timestamp_ntz"))
    run(first, root)
    built = run(cat, root)          # second run: incremental models refresh, tables rebuild
    assert set(built) == set(MODELS)
    p = Params()
    expected = {
        "orders_with_customer": M.orders_with_customer(cat, p),
        "item_type_counts": M.item_type_counts(cat, p),
        "high_value_purchases": M.expensive_items_of_high_value_detail(cat, p),
        "sales_call_plan": SP.sales_call_plan(cat, p),
        "email_activity": EM.email_activity(cat, p),
        "spend_per_customer": M.spend_and_last_order(cat, p),
    }
    for name, want in expected.items():
        got = read_model(cat, root, name)
        if got is None:
            assert want.count() == 0, name
            continue
        assert _same(got.select(*want.columns), want), name
    rank = read_model(cat, root, "monthly_product_rank")
    full = M.monthly_product_rank(cat, p)
    assert _same(rank.select(*full.columns), full)


def test_catalog_from_stored_paths(spark):
    """Production form: each source name maps to a stored Parquet dataset."""
    from martlet.sources.catalog import Catalog
    fixture = fixture_catalog(spark, SF)
    root = scratch_path(spark, "stored")
    paths = {}
    for name in fixture.names():
        paths[name] = f"{root}/{name}"
        fixture.table(name).write.parquet(paths[name])
    stored = Catalog.from_paths(spark, paths)
    p = Params()
    for build in (M.item_type_counts, SP.sales_call_plan, EM.email_activity, M.monthly_product_rank):
        assert _same(build(stored, p), build(fixture, p)), build.__name__
    # a qualified name resolves by its last part
    assert stored.table("`proj`.sales.fct_orders").count() == fixture.table("fct_orders").count()
