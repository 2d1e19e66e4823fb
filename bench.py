"""Benchmark the headline queries.

Runs each query over whole tables of ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and forces full execution with
the ``noop`` sink (every row produced, nothing collected). Each query is
built and run twice and the faster run is reported (plan building, including
any eager staging, is inside the timed part). Prints one JSON line:
{"metric", "value" (sum of headline query seconds), "unit", "queries", "sf"}.

Also times the three comparisons the baseline asks for: J4 two-branch UNION
vs one pass, J17 full refresh vs one increment, whole-set MAX() OVER () vs a
scalar subquery.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from martlet.plans import email_activity as EM  # noqa: E402
from martlet.plans import incremental_models as IM  # noqa: E402
from martlet.plans import orders as M  # noqa: E402
from martlet.plans import sales_plan as SP  # noqa: E402
from martlet.plans.params import Params  # noqa: E402
from martlet.session import build_session, scratch_path  # noqa: E402
from martlet.sources.catalog import fixture_catalog  # noqa: E402
from martlet.sources.target import Target  # noqa: E402


def timed(fn, repeat: int = 2) -> float:
    best = None
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        el = time.perf_counter() - t
        best = el if best is None else min(best, el)
    return round(best, 3)


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app_name="martlet-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "16g"})
    cat = fixture_catalog(spark, sf_dir)
    p = Params()

    # warm-up: JVM, Python workers, file listing
    run_noop(cat.table("order_items"))
    run_noop(M.monthly_product_rank(cat, p).limit(1))

    headline = {
        "j01_orders_with_customer": lambda: M.orders_with_customer(cat, p),
        "j02_spend_per_customer": lambda: M.spend_per_customer_name(cat, p),
        "j03_recent_products": lambda: M.recent_products(cat, p),
        "j04_item_type_counts": lambda: M.item_type_counts(cat, p),
        "j05_expensive_items_high_value": lambda: M.expensive_items_of_high_value(cat, p),
        "j06_monthly_product_rank": lambda: M.monthly_product_rank(cat, p),
        "j07_sales_call_plan": lambda: SP.sales_call_plan(cat, p),
        "j08_email_activity": lambda: EM.email_activity(cat, p),
    }
    queries = {k: timed(lambda f=f: run_noop(f())) for k, f in headline.items()}

    extra = {}
    extra["j04_two_branch_union"] = timed(lambda: run_noop(M.item_type_counts_two_branch(cat, p)))

    # Full refresh vs one increment after loading history up to 2001-01-01
    t_full = Target(spark, scratch_path(spark, "bench-j17-full"), IM.MONTHLY_RANK)
    extra["j17_full_refresh"] = timed(lambda: IM.refresh_monthly_rank(cat, t_full, full_refresh=True))
    # each timed increment starts from the same target state: history up to 2001-01-01
    before = cat.with_filter("fct_orders", F.col("ordered_at") < F.lit("2001-01-01").cast("timestamp_ntz"))
    runs = []
    for i in range(2):
        t_inc = Target(spark, scratch_path(spark, f"bench-j17-inc{i}"), IM.MONTHLY_RANK)
        IM.refresh_monthly_rank(before, t_inc)
        runs.append(timed(lambda t=t_inc: IM.refresh_monthly_rank(cat, t), repeat=1))
    extra["j17_increment"] = min(runs)

    plan = cat.table("stg_mccp_prod_plan").select("external_id_vod__c", "modified_date")
    extra["f03_max_over_empty_window"] = timed(lambda: run_noop(
        plan.withColumn("m", F.max("modified_date").over(Window.partitionBy()))))
    extra["d09_scalar_subquery_max"] = timed(lambda: run_noop(
        plan.withColumn("m", cat.table("stg_mccp_prod_plan").agg(F.max("modified_date")).scalar())))

    sf_match = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total_seconds",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": {**queries, **extra},
        "sf": float(sf_match.group(1)) if sf_match else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
