"""E-mail activity per product, territory and month, under row-level security.

The user's grants become a per-row weight (``rls_weight``): a fact row
counted once per matching grant, exactly as the reference's join would
duplicate it, but without duplicating rows or a nested-loop join. Measures
are sums of weighted values; the grouping keys are (product, territory,
year, month) and the derived labels are computed on the grouped rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.dates import cycle_of_month
from martlet.operators.joins import rls_weight
from martlet.plans.params import Params, resolve_user
from martlet.sources.catalog import Catalog

TERRITORY_MARK = "%CSO%"
FAILED_MARK = "%ailed%"


def email_activity(cat: Catalog, params: Params = Params()) -> DataFrame:
    facts = cat.table("f_sent_email_atvy").where(F.col("terr_id").like(TERRITORY_MARK))
    ts = F.col("email_sent_dt").cast("timestamp_ntz")
    w = F.col("_rls_w")
    rows = (rls_weight(facts, cat.table("rls_user_auth_mast"), resolve_user(cat, params))
            .select("prod_nm", "terr_id",
                    F.year(ts).alias("_y"), F.month(ts).alias("_m"),
                    F.when(F.col("sent_email_nm").isNotNull(), w).otherwise(F.lit(0)).alias("_sent"),
                    (F.when(F.col("status").like(FAILED_MARK), 1).otherwise(0) * w).alias("_failed"),
                    (F.col("opened") * w).alias("_opened"),
                    (F.col("clicked") * w).alias("_clicked"),
                    (F.col("open_count") * w).alias("_open_count"),
                    (F.col("click_count") * w).alias("_click_count")))
    agg = rows.groupBy("prod_nm", "terr_id", "_y", "_m").agg(
        F.sum("_sent").alias("all_email"),
        F.sum("_failed").alias("failed_email"),
        F.sum("_opened").alias("open_unique"),
        F.sum("_clicked").alias("clicked_unique"),
        F.sum("_open_count").alias("sum_open_count"),
        F.sum("_click_count").alias("sum_clicked"))
    year_txt, month_txt = F.col("_y").cast("string"), F.col("_m").cast("string")
    return (agg.select(
                "prod_nm", "terr_id", "all_email", "failed_email",
                (F.col("all_email") - F.col("failed_email")).alias("delivered_email"),
                "open_unique", "clicked_unique", "sum_open_count", "sum_clicked",
                month_txt.alias("mes"), year_txt.alias("year"),
                # Reproduces the reference label: October 2024 -> '2024010'.
                F.concat(year_txt, F.lit("0"), month_txt).alias("fecha"),
                cycle_of_month(F.col("_m")).alias("ciclo"),
                F.concat(year_txt, F.lpad(month_txt, 2, "0")).alias("fecha_iso"))
            .orderBy("prod_nm", "terr_id", "year", "mes"))
