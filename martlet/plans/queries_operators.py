"""

Each runs one operator family over whole fixture tables, written with the
package's helpers, next to a DuckDB statement that states the operator the
way the reference's SQL does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions import dates as D
from martlet.functions import text as X
from martlet.functions.predicates import all_of, any_of
from martlet.operators import aggregates as A
from martlet.operators import joins as J
from martlet.operators.ranking import rank_within
from martlet.operators.setops import union_all, unpivot_structs
from martlet.plans import email_activity as EM
from martlet.plans import orders as M
from martlet.plans import sales_plan as SP
from martlet.plans.params import FIXTURE, Params, resolve_as_of
from martlet.plans.queries_models import (
    AS_OF, ITEM_TYPE_COUNTS_SQL, ORDERS_WITH_CUSTOMER_SQL, RECENT_CUT, email_sql, visible_mails_sql)
from martlet.plans.registry import register
from martlet.sources.catalog import Catalog

P = FIXTURE
EXT_SQL = "external_id_vod__c"
CYCLE_SQL = f"right(split_part({EXT_SQL}, '_', 1), 2)"
YEAR_SQL = f"split_part({EXT_SQL}, '-', 2)"
TERR_SQL = f"split_part({EXT_SQL}, '_', 2)"
TEAM_SQL = (f"CASE WHEN {EXT_SQL} LIKE '%PLUS%' THEN left({TERR_SQL}, 14) "
            f"ELSE left({TERR_SQL}, 9) END")


def _o(cat: Catalog) -> DataFrame:
    return cat.table("fct_orders")


def _i(cat: Catalog) -> DataFrame:
    return cat.table("order_items")


def _c(cat: Catalog) -> DataFrame:
    return cat.table("dim_customers")


def _plan(cat: Catalog) -> DataFrame:
    return cat.table("stg_mccp_prod_plan")


def _mail(cat: Catalog) -> DataFrame:
    return cat.table("f_sent_email_atvy")


def _recent_orders(cat: Catalog) -> DataFrame:
    as_of = resolve_as_of(cat, P)
    return _o(cat).where(D.day_of("ordered_at") >= D.days_ago(F.lit(as_of), P.recent_days))


# ============================================================== C: projections, filters
register("c01_projection", "SELECT order_id, customer_id, order_total FROM fct_orders")(
    lambda cat: _o(cat).select("order_id", "customer_id", "order_total"))
register("c02_rename", "SELECT customer_id, name AS customer_name FROM dim_customers")(
    lambda cat: _c(cat).select("customer_id", F.col("name").alias("customer_name")))
register("c03_constant_column",
         "SELECT order_item_id, 'food' AS item_type FROM order_items WHERE is_food_item = 1")(
    lambda cat: _i(cat).where(F.col("is_food_item") == 1)
    .select("order_item_id", F.lit("food").alias("item_type")))
register("c04_numeric_range", f"""
SELECT order_item_id, product_price FROM order_items WHERE product_price > {P.price_min}""")(
    lambda cat: _i(cat).where(F.col("product_price") > P.price_min).select("order_item_id", "product_price"))
register("c05_equality_inequality", f"""
SELECT {EXT_SQL}, product_name_vod__c FROM stg_mccp_prod_plan
WHERE ropu_nm = 'SPAIN' AND {CYCLE_SQL} != 'ES'""")(
    lambda cat: _plan(cat).where((F.col("ropu_nm") == "SPAIN") & (SP.plan_cycle() != "ES"))
    .select("external_id_vod__c", "product_name_vod__c"))
register("c06_disjunction", """
SELECT order_item_id FROM order_items WHERE is_food_item = 1 OR is_drink_item = 1""")(
    lambda cat: _i(cat).where(any_of([F.col("is_food_item") == 1, F.col("is_drink_item") == 1]))
    .select("order_item_id"))
register("c07_in_list", f"""
SELECT {EXT_SQL}, channel_vod__c FROM stg_mccp_prod_plan WHERE channel_vod__c IN ('ES_F2F', 'ES_S2S')""")(
    lambda cat: _plan(cat).where(F.col("channel_vod__c").isin(SP.CHANNELS))
    .select("external_id_vod__c", "channel_vod__c"))
register("c08_pattern_match", """
SELECT prod_nm, terr_id, status FROM f_sent_email_atvy
WHERE terr_id LIKE '%CSO%' AND status LIKE '%ailed%'""")(
    lambda cat: _mail(cat).where(F.col("terr_id").like("%CSO%") & F.col("status").like("%ailed%"))
    .select("prod_nm", "terr_id", "status"))
register("c09_null_test", f"""
SELECT {EXT_SQL}, last_activity_datetime_vod__c FROM stg_mccp_prod_plan
WHERE last_activity_datetime_vod__c IS NOT NULL""")(
    lambda cat: _plan(cat).where(F.col("last_activity_datetime_vod__c").isNotNull())
    .select("external_id_vod__c", "last_activity_datetime_vod__c"))
register("c10_recent_filter_date_wrapped", f"""
SELECT order_id, ordered_at FROM fct_orders WHERE CAST(ordered_at AS DATE) >= {RECENT_CUT}""")(
    lambda cat: _recent_orders(cat).select("order_id", "ordered_at"))


@register("c11_recent_filter_timestamp", f"""
SELECT order_id, ordered_at FROM fct_orders WHERE ordered_at >= CAST({RECENT_CUT} AS TIMESTAMP)""")
def _c11(cat: Catalog) -> DataFrame:
    as_of = resolve_as_of(cat, P)
    return (_o(cat).where(F.col("ordered_at") >= D.as_timestamp(D.days_ago(F.lit(as_of), P.recent_days)))
            .select("order_id", "ordered_at"))


register("c12_case_when", f"SELECT {EXT_SQL}, {TEAM_SQL} AS team FROM stg_mccp_prod_plan")(
    lambda cat: _plan(cat).select("external_id_vod__c", SP.plan_team().alias("team")))


@register("c13_reuse_alias_in_select", f"""
SELECT {EXT_SQL}, {CYCLE_SQL} AS ciclo,
       CASE WHEN {CYCLE_SQL} IN ('C1') THEN {YEAR_SQL} || '-01-01'
            WHEN {CYCLE_SQL} IN ('C2') THEN {YEAR_SQL} || '-05-01'
            WHEN {CYCLE_SQL} IN ('C3') THEN {YEAR_SQL} || '-09-01' END AS firstdaycicle
FROM stg_mccp_prod_plan""")
def _c13(cat: Catalog) -> DataFrame:
    df = _plan(cat).withColumn("ciclo", SP.plan_cycle()).withColumn("year", SP.plan_year())
    return df.select("external_id_vod__c", "ciclo", D.cycle_first_day_text("year", "ciclo").alias("firstdaycicle"))


@register("c14_alias_in_where_and_group_by", f"""
SELECT {CYCLE_SQL} AS ciclo, count(*) AS n_rows FROM stg_mccp_prod_plan
WHERE {CYCLE_SQL} != 'ES' GROUP BY 1""")
def _c14(cat: Catalog) -> DataFrame:
    df = _plan(cat).withColumn("ciclo", SP.plan_cycle())
    return df.where(F.col("ciclo") != "ES").groupBy("ciclo").agg(F.count(F.lit(1)).alias("n_rows"))


register("c15_true_base_predicate", """
SELECT order_id, order_total FROM fct_orders WHERE TRUE AND order_total > 200000""")(
    lambda cat: _o(cat).where(all_of([F.col("order_total") > 200000])).select("order_id", "order_total"))

# ============================================================== D: joins
register("d01_inner_equi_join", """
SELECT o.order_id, oi.product_id, o.ordered_at FROM fct_orders o JOIN order_items oi ON o.order_id = oi.order_id""")(
    lambda cat: _i(cat).select("order_id", "product_id")
    .join(_o(cat).select("order_id", "ordered_at"), "order_id").select("order_id", "product_id", "ordered_at"))
register("d02_star_join", """
SELECT c.name, o.order_id, oi.product_id
FROM dim_customers c JOIN fct_orders o ON c.customer_id = o.customer_id
     JOIN order_items oi ON o.order_id = oi.order_id""")(
    lambda cat: _i(cat).select("order_id", "product_id")
    .join(_o(cat).select("order_id", "customer_id"), "order_id")
    .join(_c(cat), "customer_id").select("name", "order_id", "product_id"))
register("d03_left_lookup", ORDERS_WITH_CUSTOMER_SQL)(lambda cat: M.orders_with_customer(cat, P))

RECENT_ORDERS_SQL = f"SELECT * FROM fct_orders WHERE CAST(ordered_at AS DATE) >= {RECENT_CUT}"
register("d04_right_join_keeps_orders", f"""
SELECT o.order_id, oi.product_id, oi.product_price, o.ordered_at
FROM order_items oi RIGHT JOIN ({RECENT_ORDERS_SQL}) o ON o.order_id = oi.order_id""")(
    lambda cat: _i(cat).select("order_id", "product_id", "product_price")
    .join(_recent_orders(cat).select("order_id", "ordered_at"), "order_id", "right")
    .select("order_id", "product_id", "product_price", "ordered_at"))


@register("d05_right_join_null_rejecting", f"""
SELECT oi.product_id, oi.product_price, o.ordered_at
FROM fct_orders o RIGHT JOIN order_items oi ON o.order_id = oi.order_id
WHERE CAST(o.ordered_at AS DATE) >= {RECENT_CUT}""")
def _d05(cat: Catalog) -> DataFrame:
    as_of = resolve_as_of(cat, P)
    j = _o(cat).select("order_id", "ordered_at").join(
        _i(cat).select("order_id", "product_id", "product_price"), "order_id", "right")
    # Catalyst turns the outer join into an inner one: the filter rejects NULLs.
    return (j.where(D.day_of("ordered_at") >= D.days_ago(F.lit(as_of), P.recent_days))
            .select("product_id", "product_price", "ordered_at"))


@register("d06_left_join_not_null", f"""
SELECT oi.product_id, oi.product_price, o.ordered_at
FROM order_items oi LEFT JOIN ({RECENT_ORDERS_SQL}) o ON o.order_id = oi.order_id
WHERE o.ordered_at IS NOT NULL""")
def _d06(cat: Catalog) -> DataFrame:
    j = _i(cat).select("order_id", "product_id", "product_price").join(
        _recent_orders(cat).select("order_id", "ordered_at"), "order_id", "left")
    return j.where(F.col("ordered_at").isNotNull()).select("product_id", "product_price", "ordered_at")


register("d07_left_join_prefiltered_keeps_unmatched", f"""
SELECT oi.product_id, oi.product_price, o.ordered_at
FROM order_items oi LEFT JOIN ({RECENT_ORDERS_SQL}) o ON o.order_id = oi.order_id""")(
    lambda cat: _i(cat).select("order_id", "product_id", "product_price")
    .join(_recent_orders(cat).select("order_id", "ordered_at"), "order_id", "left")
    .select("product_id", "product_price", "ordered_at"))


@register("d08_comma_join", """
SELECT o.order_id, oi.product_price FROM fct_orders o, order_items oi WHERE o.order_id = oi.order_id""")
def _d08(cat: Catalog) -> DataFrame:
    cat.register_views()
    return cat.spark.sql("SELECT o.order_id, oi.product_price FROM fct_orders o, order_items oi "
                         "WHERE o.order_id = oi.order_id")


register("d09_attach_one_row_aggregate", f"""
SELECT {EXT_SQL}, modified_date, m.max_modified_date
FROM stg_mccp_prod_plan CROSS JOIN (SELECT max(modified_date) AS max_modified_date FROM stg_mccp_prod_plan) m""")(
    lambda cat: J.with_scalar(_plan(cat).select("external_id_vod__c", "modified_date"),
                              _plan(cat).agg(F.max("modified_date").alias("max_modified_date"))))
SPENDERS = f"SELECT customer_id FROM fct_orders GROUP BY ALL HAVING sum(order_total) > {P.spend_min}"
register("d10_semi_join_in_subquery", f"""
SELECT customer_id, name FROM dim_customers WHERE customer_id IN (SELECT customer_id FROM ({SPENDERS}))""")(
    lambda cat: J.semi(_c(cat), M.high_value_customers(cat, P), "customer_id"))
register("d11_join_to_having_aggregate", f"""
SELECT customer_id, name FROM dim_customers JOIN ({SPENDERS}) USING (customer_id)""")(
    lambda cat: _c(cat).join(M.high_value_customers(cat, P), "customer_id").select("customer_id", "name"))
register("d13_uncorrelated_scalar_subquery", f"""
SELECT {EXT_SQL}, product_name_vod__c, modified_date FROM stg_mccp_prod_plan
WHERE modified_date = (SELECT max(modified_date) FROM stg_mccp_prod_plan)""")(
    lambda cat: _plan(cat).where(F.col("modified_date") == _plan(cat).agg(F.max("modified_date")).scalar())
    .select("external_id_vod__c", "product_name_vod__c", "modified_date"))
register("d14_row_level_security_join", f"""
SELECT prod_nm, terr_id, cntry_cd, sent_email_nm
FROM (SELECT *, unnest(range(seen)) FROM ({visible_mails_sql('analyst')}))""")(
    lambda cat: J.rls_join(_mail(cat), cat.table("rls_user_auth_mast"), "analyst")
    .select("prod_nm", "terr_id", "cntry_cd", "sent_email_nm"))
register("d15_join_prefiltered_inputs", f"""
WITH expensive AS (SELECT order_id, product_id, product_price FROM order_items WHERE product_price > {P.price_min})
SELECT e.order_id, e.product_id, e.product_price, o.customer_id
FROM expensive e JOIN fct_orders o ON e.order_id = o.order_id""")(
    lambda cat: _i(cat).where(F.col("product_price") > P.price_min)
    .select("order_id", "product_id", "product_price")
    .join(_o(cat).select("order_id", "customer_id"), "order_id"))
register("d16_preaggregated_side_join", """
WITH per_order AS (SELECT order_id, product_id, sum(product_price) AS item_revenue
                   FROM order_items GROUP BY order_id, product_id)
SELECT p.order_id, p.product_id, o.ordered_at, round(p.item_revenue, 2) AS item_revenue
FROM per_order p JOIN fct_orders o ON p.order_id = o.order_id""")(
    lambda cat: _i(cat).groupBy("order_id", "product_id").agg(F.sum("product_price").alias("_rev"))
    .join(_o(cat).select("order_id", "ordered_at"), "order_id")
    .select("order_id", "product_id", "ordered_at", F.round("_rev", 2).alias("item_revenue")))

# ============================================================== E: aggregations
register("e01_grouped_sum", """
SELECT customer_id, round(sum(order_total), 2) AS total_spent FROM fct_orders GROUP BY customer_id""")(
    lambda cat: _o(cat).groupBy("customer_id").agg(F.round(F.sum("order_total"), 2).alias("total_spent")))
register("e02_non_null_count", """
SELECT terr_id, count(sent_email_nm) AS all_email, count(*) AS n_rows FROM f_sent_email_atvy GROUP BY terr_id""")(
    lambda cat: _mail(cat).groupBy("terr_id").agg(F.count("sent_email_nm").alias("all_email"),
                                                  F.count(F.lit(1)).alias("n_rows")))
register("e03_max_per_group", f"""
SELECT {EXT_SQL}, max(modified_date) AS max_modified_date, max(systemmodstamp) AS max_systemmodstamp
FROM stg_mccp_prod_plan GROUP BY {EXT_SQL}""")(
    lambda cat: _plan(cat).groupBy("external_id_vod__c").agg(
        # as a date: its buffer is of fixed width, so the aggregate hashes instead of sorting all rows
        D.iso_date_text(F.max(D.parse_iso_date("modified_date"))).alias("max_modified_date"),
        F.max("systemmodstamp").alias("max_systemmodstamp")))
register("e04_global_max", "SELECT max(modified_date) AS max_modified_date FROM stg_mccp_prod_plan")(
    lambda cat: _plan(cat).agg(F.max("modified_date").alias("max_modified_date")))
register("e05_conditional_count", """
SELECT order_id, count(*) FILTER (WHERE is_food_item = 1) AS food_items FROM order_items GROUP BY order_id""")(
    lambda cat: _i(cat).groupBy("order_id").agg(A.count_when(F.col("is_food_item") == 1).alias("food_items")))

ATT_FC = "product_attainment_vod__c >= 80 AND channel_vod__c IN ('ES_F2F', 'ES_S2S')"
register("e06_conditional_sum_zero_when_none", f"""
SELECT {EXT_SQL}, CAST(sum(CASE WHEN {ATT_FC} THEN 1 ELSE 0 END) AS BIGINT) AS fc
FROM stg_mccp_prod_plan GROUP BY {EXT_SQL}""")(
    lambda cat: _plan(cat).groupBy("external_id_vod__c").agg(A.sum_when_else_zero(
        (F.col("product_attainment_vod__c") >= 80) & F.col("channel_vod__c").isin(SP.CHANNELS))
        .cast("long").alias("fc")))
register("e07_conditional_sum_null_when_none", f"""
SELECT {EXT_SQL}, CAST(sum(CASE WHEN {ATT_FC} THEN 1 END) AS BIGINT) AS fc
FROM stg_mccp_prod_plan GROUP BY {EXT_SQL}""")(
    lambda cat: _plan(cat).groupBy("external_id_vod__c").agg(A.sum_when_or_null(
        (F.col("product_attainment_vod__c") >= 80) & F.col("channel_vod__c").isin(SP.CHANNELS))
        .cast("long").alias("fc")))
register("e08_having", f"""
SELECT customer_id, round(sum(order_total), 2) AS total_spent FROM fct_orders
GROUP BY customer_id HAVING sum(order_total) > {P.spend_min}""")(
    lambda cat: A.having(_o(cat).groupBy("customer_id").agg(F.sum("order_total").alias("_s")),
                         F.col("_s") > P.spend_min)
    .select("customer_id", F.round("_s", 2).alias("total_spent")))
register("e09_group_by_expression", """
SELECT strftime(ordered_at, '%Y-%m') AS order_month, count(*) AS n_orders FROM fct_orders GROUP BY 1""")(
    lambda cat: _o(cat).groupBy(D.month_label("ordered_at").alias("order_month"))
    .agg(F.count(F.lit(1)).alias("n_orders")))


@register("e10_group_by_ordinals", """
SELECT strftime(o.ordered_at, '%Y-%m') AS order_month, oi.product_id, count(*) AS n_items
FROM fct_orders o JOIN order_items oi ON o.order_id = oi.order_id GROUP BY 1, 2""")
def _e10(cat: Catalog) -> DataFrame:
    cat.register_views()
    return cat.spark.sql("""
        SELECT date_format(o.ordered_at, 'yyyy-MM') AS order_month, oi.product_id, count(*) AS n_items
        FROM fct_orders o JOIN order_items oi ON o.order_id = oi.order_id GROUP BY 1, 2""")


MONTH_PRODUCT_REVENUE_SQL = """
SELECT strftime(o.ordered_at, '%Y-%m') AS order_month, oi.product_id,
       round(sum(oi.product_price), 2) AS total_revenue
FROM fct_orders o JOIN order_items oi ON o.order_id = oi.order_id GROUP BY 1, 2"""


@register("e11_two_level_aggregation", MONTH_PRODUCT_REVENUE_SQL)
def _e11(cat: Catalog) -> DataFrame:
    per_order = _i(cat).groupBy("order_id", "product_id").agg(F.sum("product_price").alias("_rev"))
    return (per_order.join(_o(cat).select("order_id", "ordered_at"), "order_id")
            .groupBy(D.month_label("ordered_at").alias("order_month"), "product_id")
            .agg(F.round(F.sum("_rev"), 2).alias("total_revenue")))


register("e12_aggregate_then_attach_dimension", """
SELECT c.name AS customer_name, round(o.total_spent, 2) AS total_spent, o.last_order_date
FROM (SELECT customer_id, sum(order_total) AS total_spent, max(ordered_at) AS last_order_date
      FROM fct_orders GROUP BY customer_id) o
JOIN dim_customers c ON o.customer_id = c.customer_id""")(lambda cat: M.spend_and_last_order(cat, P))
register("e13_distinct_rows", "SELECT DISTINCT product_id, product_price FROM order_items")(
    lambda cat: A.distinct_rows(_i(cat), ["product_id", "product_price"]))
register("e14_distinct_by_group_by", "SELECT product_id, product_price FROM order_items GROUP BY 1, 2")(
    lambda cat: _i(cat).groupBy("product_id", "product_price").agg(F.count(F.lit(1)).alias("_n"))
    .select("product_id", "product_price"))
register("e15_null_group_replaced", """
SELECT COALESCE(c.name, 'Unknown') AS customer_name, round(sum(o.order_total), 2) AS total_spent
FROM fct_orders o LEFT JOIN dim_customers c ON o.customer_id = c.customer_id
GROUP BY COALESCE(c.name, 'Unknown')""")(
    lambda cat: M.spend_per_customer_name(cat, P, how="left", unknown_label="Unknown"))
register("e16_derived_measure", """
SELECT terr_id, CAST(count(sent_email_nm) - sum(CASE WHEN status LIKE '%ailed%' THEN 1 ELSE 0 END) AS BIGINT)
         AS delivered_email
FROM f_sent_email_atvy GROUP BY terr_id""")(
    lambda cat: _mail(cat).groupBy("terr_id").agg(
        (F.count("sent_email_nm") - A.sum_when_else_zero(F.col("status").like("%ailed%")))
        .cast("long").alias("delivered_email")))
register("e17_many_measures_one_pass", email_sql("analyst"))(lambda cat: EM.email_activity(cat, P))
register("e18_count_of_computed_one", """
SELECT order_id, count(1) AS order_item_count FROM order_items GROUP BY order_id""")(
    lambda cat: _i(cat).select("order_id", F.lit(1).alias("_one")).groupBy("order_id")
    .agg(F.count("_one").alias("order_item_count")))

# ============================================================== F, G: windows and sorts
register("f01_rank_over_aggregate", f"""
SELECT strftime(o.ordered_at, '%Y-%m') AS order_month, oi.product_id,
       round(sum(oi.product_price), 2) AS total_revenue,
       CAST(rank() OVER (PARTITION BY strftime(o.ordered_at, '%Y-%m')
                         ORDER BY round(sum(oi.product_price), 2) DESC) AS BIGINT) AS rank
FROM fct_orders o JOIN order_items oi ON o.order_id = oi.order_id GROUP BY 1, 2""")(
    lambda cat: M.monthly_product_rank(cat, P))


@register("f02_rank_over_preaggregated", """
WITH agg AS (
  SELECT c.name, strftime(o.ordered_at, '%Y') AS order_year, round(sum(o.order_total), 2) AS total_spent
  FROM fct_orders o JOIN dim_customers c ON o.customer_id = c.customer_id GROUP BY 1, 2)
SELECT name, order_year, total_spent,
       CAST(rank() OVER (PARTITION BY order_year ORDER BY total_spent DESC) AS BIGINT) AS rank
FROM agg""")
def _f02(cat: Catalog) -> DataFrame:
    agg = (_o(cat).join(_c(cat), "customer_id")
           .groupBy("name", F.date_format("ordered_at", "yyyy").alias("order_year"))
           .agg(F.round(F.sum("order_total"), 2).alias("total_spent")))
    return rank_within(agg, ["order_year"], "total_spent", "rank")


register("f03_whole_set_max", f"""
SELECT {EXT_SQL}, modified_date, max(modified_date) OVER () AS max_modified_date FROM stg_mccp_prod_plan""")(
    # MAX() OVER () would move every row to one task; a scalar subquery does not.
    lambda cat: J.with_scalar(_plan(cat).select("external_id_vod__c", "modified_date"),
                              _plan(cat).agg(F.max("modified_date").alias("max_modified_date"))))
register("g01_sort_descending", """
SELECT customer_name, total_spent FROM (
  SELECT (SELECT c.name FROM dim_customers c WHERE c.customer_id = o.customer_id) AS customer_name,
         round(sum(o.order_total), 2) AS total_spent
  FROM fct_orders o GROUP BY customer_name) t ORDER BY total_spent DESC""")(
    lambda cat: M.spend_per_customer_name(cat, P))
register("g02_multi_column_sort", email_sql("admin"))(lambda cat: EM.email_activity(cat, Params(user="admin")))

# ============================================================== H: set operations
ITEM_TYPE_BRANCH_SQL = ITEM_TYPE_COUNTS_SQL.replace("\nUNION\n", "\nUNION ALL\n")


@register("h02_union_all", ITEM_TYPE_BRANCH_SQL)
def _h02(cat: Catalog) -> DataFrame:
    def branch(flag: str, label: str) -> DataFrame:
        j = (_i(cat).where(F.col(flag) == 1).select("order_id", "order_item_id")
             .join(_o(cat).select("order_id", "customer_id"), "order_id").join(_c(cat), "customer_id"))
        return (j.groupBy("name").agg(F.count("order_item_id").alias("item_count"))
                .select("name", "item_count", F.lit(label).alias("item_type")))
    return union_all([branch("is_food_item", "food"), branch("is_drink_item", "drink")])


register("h03_unpivot_one_pass", ITEM_TYPE_COUNTS_SQL)(lambda cat: M.item_type_counts(cat, P))


@register("h04_unpivot_array_of_structs", ITEM_TYPE_COUNTS_SQL)
def _h04(cat: Catalog) -> DataFrame:
    per = (_i(cat).select("order_id", "order_item_id", "is_food_item", "is_drink_item")
           .join(_o(cat).select("order_id", "customer_id"), "order_id")
           .join(_c(cat), "customer_id")
           .groupBy("name")
           .agg(A.count_when(F.col("is_food_item") == 1, F.col("order_item_id")).alias("food"),
                A.count_when(F.col("is_food_item") == 1).alias("food_rows"),
                A.count_when(F.col("is_drink_item") == 1, F.col("order_item_id")).alias("drink"),
                A.count_when(F.col("is_drink_item") == 1).alias("drink_rows")))
    per = per.select("name", F.when(F.col("food_rows") > 0, F.col("food")).alias("food"),
                     F.when(F.col("drink_rows") > 0, F.col("drink")).alias("drink"))
    return (unpivot_structs(per, ["name"], {"food": "food", "drink": "drink"}, "item_count", "item_type")
            .where(F.col("item_count").isNotNull()))


# ============================================================== I: scalar functions
register("i01_split_part", f"""
SELECT {EXT_SQL}, {YEAR_SQL} AS year, {TERR_SQL} AS terr, split_part({EXT_SQL}, '_', 1) AS head
FROM stg_mccp_prod_plan""")(
    lambda cat: _plan(cat).select("external_id_vod__c", SP.plan_year().alias("year"),
                                  SP.plan_territory().alias("terr"),
                                  X.split_part("external_id_vod__c", "_", 1).alias("head")))
register("i02_left_right", f"""
SELECT {EXT_SQL}, left({TERR_SQL}, 9) AS team9, {CYCLE_SQL} AS ciclo FROM stg_mccp_prod_plan""")(
    lambda cat: _plan(cat).select("external_id_vod__c", X.left(SP.plan_territory(), 9).alias("team9"),
                                  SP.plan_cycle().alias("ciclo")))
register("i03_concat", f"""
SELECT {EXT_SQL}, {YEAR_SQL} || right(split_part({EXT_SQL}, '_', 1), 1) AS yearciclo FROM stg_mccp_prod_plan""")(
    lambda cat: _plan(cat).select("external_id_vod__c", SP.plan_year_cycle().alias("yearciclo")))
register("i04_length", "SELECT terr_id, CAST(length(terr_id) AS INTEGER) AS terr_len FROM f_sent_email_atvy")(
    lambda cat: _mail(cat).select("terr_id", F.length("terr_id").alias("terr_len")))
register("i05_coalesce", """
SELECT o.order_id, COALESCE(c.name, 'Unknown') AS customer_name
FROM fct_orders o LEFT JOIN dim_customers c ON o.customer_id = c.customer_id""")(
    lambda cat: M.orders_with_customer(cat, P)
    .select("order_id", F.coalesce(F.col("customer_name"), F.lit("Unknown")).alias("customer_name")))
register("i06_nullif_guarded_division", f"""
SELECT {EXT_SQL}, product_activity_goal_vod__c / NULLIF(product_actual_activity_vod__c, 0) AS ratio
FROM stg_mccp_prod_plan""")(
    lambda cat: _plan(cat).select("external_id_vod__c", (F.col("product_activity_goal_vod__c") / F.nullif(
        F.col("product_actual_activity_vod__c"), F.lit(0.0))).alias("ratio")))
register("i07_casts", """
SELECT CAST(email_sent_dt AS DATE) AS sent_day, CAST(open_count AS VARCHAR) AS open_text,
       CAST(click_count AS DOUBLE) AS click_value, CAST(email_sent_dt AS TIMESTAMP) AS sent_ts
FROM f_sent_email_atvy""")(
    lambda cat: _mail(cat).select(F.col("email_sent_dt").cast("date").alias("sent_day"),
                                  F.col("open_count").cast("string").alias("open_text"),
                                  F.col("click_count").cast("double").alias("click_value"),
                                  F.col("email_sent_dt").cast("timestamp_ntz").alias("sent_ts")))
register("i08_date_of_timestamp", "SELECT order_id, CAST(ordered_at AS DATE) AS order_date FROM fct_orders")(
    lambda cat: _o(cat).select("order_id", D.day_of("ordered_at").alias("order_date")))
register("i09_current_date_parameter", f"""
SELECT order_id, ordered_at FROM fct_orders WHERE CAST(ordered_at AS DATE) = {AS_OF}""")(
    lambda cat: _o(cat).where(D.day_of("ordered_at") == F.lit(resolve_as_of(cat, P)))
    .select("order_id", "ordered_at"))
register("i10_date_sub_days", """
SELECT order_id, CAST(CAST(ordered_at AS DATE) - INTERVAL 90 DAY AS DATE) AS cut FROM fct_orders""")(
    lambda cat: _o(cat).select("order_id", D.days_ago(D.day_of("ordered_at"), 90).alias("cut")))
register("i11_date_sub_months", """
SELECT order_id, CAST(CAST(ordered_at AS DATE) - INTERVAL 2 MONTH AS DATE) AS cut FROM fct_orders""")(
    lambda cat: _o(cat).select("order_id", D.months_ago(D.day_of("ordered_at"), 2).alias("cut")))
register("i12_timestamp_of_date", """
SELECT order_id, CAST(CAST(ordered_at AS DATE) AS TIMESTAMP) AS day_start FROM fct_orders""")(
    lambda cat: _o(cat).select("order_id", D.as_timestamp(D.day_of("ordered_at")).alias("day_start")))
register("i13_date_trunc_month", """
SELECT order_id, CAST(date_trunc('month', ordered_at) AS DATE) AS order_month FROM fct_orders""")(
    lambda cat: _o(cat).select("order_id", D.month_start("ordered_at").alias("order_month")))
register("i14_format_timestamp", "SELECT order_id, strftime(ordered_at, '%Y-%m') AS order_month FROM fct_orders")(
    lambda cat: _o(cat).select("order_id", D.month_label("ordered_at").alias("order_month")))
register("i15_parse_month_label", """
SELECT order_id, CAST(strptime(strftime(ordered_at, '%Y-%m'), '%Y-%m') AS DATE) AS month_date FROM fct_orders""")(
    lambda cat: _o(cat).select("order_id", D.parse_month_label(D.month_label("ordered_at")).alias("month_date")))
register("i16_extract_year_month", """
SELECT order_id, CAST(EXTRACT(YEAR FROM ordered_at) AS INTEGER) AS y,
       CAST(EXTRACT(MONTH FROM ordered_at) AS INTEGER) AS m FROM fct_orders""")(
    lambda cat: _o(cat).select("order_id", F.year("ordered_at").alias("y"), F.month("ordered_at").alias("m")))
register("i17_to_date_iso_text", f"""
SELECT {EXT_SQL}, CAST(strptime(modified_date, '%Y-%m-%d') AS DATE) AS modified_day FROM stg_mccp_prod_plan""")(
    lambda cat: _plan(cat).select("external_id_vod__c", D.parse_iso_date("modified_date").alias("modified_day")))
register("i18_date_to_text", "SELECT order_id, strftime(CAST(ordered_at AS DATE), '%Y-%m-%d') AS d FROM fct_orders")(
    lambda cat: _o(cat).select("order_id", D.iso_date_text(D.day_of("ordered_at")).alias("d")))

A_DAY = "CAST(systemmodstamp AS DATE)"
B_DAY = "CAST(strptime(modified_date, '%Y-%m-%d') AS DATE)"
WEEKS_SQL = f"date_diff('day', date_trunc('week', {A_DAY}), date_trunc('week', {B_DAY})) // 7"


def _plan_days(cat: Catalog) -> DataFrame:
    return _plan(cat).select("external_id_vod__c", D.day_of("systemmodstamp").alias("_a"),
                             D.parse_iso_date("modified_date").alias("_b"))


register("i19_datediff_days", f"""
SELECT {EXT_SQL}, CAST(date_diff('day', {A_DAY}, {B_DAY}) AS INTEGER) AS days FROM stg_mccp_prod_plan""")(
    lambda cat: _plan_days(cat).select("external_id_vod__c", D.day_diff("_a", "_b").alias("days")))
register("i20_datediff_week_boundaries", f"""
SELECT {EXT_SQL}, CAST({WEEKS_SQL} AS INTEGER) AS weeks FROM stg_mccp_prod_plan""")(
    lambda cat: _plan_days(cat).select("external_id_vod__c", D.week_boundaries("_a", "_b").alias("weeks")))
register("i21_working_days", f"""
SELECT {EXT_SQL}, CAST(({WEEKS_SQL}) * 5 + (date_diff('day', {A_DAY}, {B_DAY}) - ({WEEKS_SQL}) * 7) AS INTEGER)
         AS working_days
FROM stg_mccp_prod_plan""")(
    lambda cat: _plan_days(cat).select("external_id_vod__c", D.working_days("_a", "_b").alias("working_days")))
register("i22_round_half_up", f"""
SELECT {EXT_SQL}, product_attainment_vod__c, round(product_attainment_vod__c) AS attainment_round
FROM stg_mccp_prod_plan""")(
    lambda cat: _plan(cat).select("external_id_vod__c", "product_attainment_vod__c",
                                  F.round("product_attainment_vod__c", 0).alias("attainment_round")))
register("i23_arithmetic", f"""
SELECT {EXT_SQL}, product_activity_goal_vod__c * product_actual_activity_vod__c
       / (product_interactions_actual_vod__c + 1) - product_attainment_vod__c AS score
FROM stg_mccp_prod_plan""")(
    lambda cat: _plan(cat).select("external_id_vod__c", (
        F.col("product_activity_goal_vod__c") * F.col("product_actual_activity_vod__c")
        / (F.col("product_interactions_actual_vod__c") + 1) - F.col("product_attainment_vod__c")).alias("score")))
register("i24_fiscal_cycle_of_month", """
SELECT prod_nm, email_sent_dt,
       CASE WHEN month(email_sent_dt) IN (1, 2, 3, 4) THEN 'C1' WHEN month(email_sent_dt) IN (5, 6, 7, 8) THEN 'C2'
            WHEN month(email_sent_dt) IN (9, 10, 11, 12) THEN 'C3' END AS ciclo
FROM f_sent_email_atvy""")(
    lambda cat: _mail(cat).select("prod_nm", "email_sent_dt", D.cycle_of_month(F.month("email_sent_dt")).alias("ciclo")))
register("i25_cycle_first_last_day", f"""
SELECT {EXT_SQL},
       CASE WHEN {CYCLE_SQL} = 'C1' THEN {YEAR_SQL} || '-01-01' WHEN {CYCLE_SQL} = 'C2' THEN {YEAR_SQL} || '-05-01'
            WHEN {CYCLE_SQL} = 'C3' THEN {YEAR_SQL} || '-09-01' END AS firstdaycicle,
       CASE WHEN {CYCLE_SQL} = 'C1' THEN {YEAR_SQL} || '-04-30' WHEN {CYCLE_SQL} = 'C2' THEN {YEAR_SQL} || '-08-31'
            WHEN {CYCLE_SQL} = 'C3' THEN {YEAR_SQL} || '-12-31' END AS lastdaycicle
FROM stg_mccp_prod_plan""")(
    lambda cat: _plan(cat).select("external_id_vod__c",
                                  D.cycle_first_day_text(SP.plan_year(), SP.plan_cycle()).alias("firstdaycicle"),
                                  D.cycle_last_day_text(SP.plan_year(), SP.plan_cycle()).alias("lastdaycicle")))
register("i26_current_user_parameter", f"""
SELECT cntry_cd, CAST(sum(seen) AS BIGINT) AS visible_rows FROM ({visible_mails_sql('admin')}) GROUP BY cntry_cd""")(
    lambda cat: J.rls_weight(_mail(cat), cat.table("rls_user_auth_mast"), "admin")
    .groupBy("cntry_cd").agg(F.sum("_rls_w").alias("visible_rows")))
register("i27_inline_array_of_structs", ITEM_TYPE_COUNTS_SQL)(lambda cat: _h04(cat))


# ============================================================== A1, A2: table resolution
register("a01_scan_qualified_name", "SELECT order_id, customer_id, order_total, ordered_at FROM fct_orders")(
    lambda cat: cat.table("`analytics-prod`.sales.fct_orders"))
register("a02_source_and_ref", """
SELECT o.order_id, c.name FROM fct_orders o JOIN dim_customers c ON o.customer_id = c.customer_id""")(
    lambda cat: cat.source("sales", "fct_orders").select("order_id", "customer_id")
    .join(cat.ref("dim_customers"), "customer_id").select("order_id", "name"))


@register("a01_tables_of_two_schemas", """
SELECT 'live' AS origin, order_id FROM fct_orders
UNION ALL SELECT 'archive', order_id FROM fct_orders WHERE ordered_at < TIMESTAMP '2000-01-01 00:00:00'""")
def _a01_schemas(cat: Catalog) -> DataFrame:
    """Two tables with one name in different schemas stay apart."""
    both = Catalog(cat.spark, {"prod.live.fct_orders": lambda: cat.table("fct_orders"),
                               "prod.archive.fct_orders": lambda: cat.table("fct_orders").where(F.col("ordered_at") < F.lit("2000-01-01").cast("timestamp_ntz"))})
    return union_all([both.table(f"prod.{schema}.fct_orders").select(F.lit(schema).alias("origin"), "order_id") for schema in ("live", "archive")])


@register("a02_tables_by_source", """
SELECT order_id, name FROM fct_orders JOIN dim_customers USING (customer_id) WHERE customer_id > 100""")
def _a02_sources(cat: Catalog) -> DataFrame:
    """A source's table is what that source declares, not the last part of its name."""
    known = Catalog(cat.spark, {"shop.orders": lambda: cat.table("fct_orders"), "crm.customers": lambda: cat.table("dim_customers").where("customer_id > 100"),
                                "shop.customers": lambda: cat.table("dim_customers")})
    known.declare_source("sales", {"fct_orders": "shop.orders"})
    known.declare_source("people", {"dim_customers": "crm.customers"})
    return (known.source("sales", "fct_orders").select("order_id", "customer_id")
            .join(known.source("people", "dim_customers"), "customer_id").select("order_id", "name"))


register("i07_text_and_fixed_width_casts", """
SELECT external_id_vod__c, CAST(modified_date || ' 06:30:15' AS TIMESTAMP) AS modified_at,
       rpad(left(product_name_vod__c, 7), 7, ' ') AS product_code, rpad(left(channel_vod__c, 4), 4, ' ') AS channel_code,
       TRY_CAST(split_part(external_id_vod__c, '-', 2) AS INTEGER) AS plan_year, TRY_CAST(ropu_nm AS INTEGER) AS no_number
FROM stg_mccp_prod_plan""")(
    lambda cat: _plan(cat).select("external_id_vod__c", X.timestamp_of_text(X.concat_text(F.col("modified_date"), " 06:30:15")).alias("modified_at"),
                                  X.fixed_width("product_name_vod__c", 7).alias("product_code"), X.fixed_width("channel_vod__c", 4).alias("channel_code"),
                                  X.safe_cast(X.split_part("external_id_vod__c", "-", 2), "int").alias("plan_year"), X.safe_cast("ropu_nm", "int").alias("no_number")))
register("i13_timestamp_trunc", """
SELECT order_id, date_trunc('month', ordered_at) AS month_at, date_trunc('hour', ordered_at) AS hour_at,
       CAST(date_trunc('week', ordered_at) AS TIMESTAMP) AS week_at FROM fct_orders""")(
    lambda cat: _o(cat).select("order_id", *[D.timestamp_trunc("ordered_at", u).alias(f"{u}_at") for u in ("month", "hour", "week")]))
register("i15_parse_timestamp", """
SELECT order_id, strptime(strftime(ordered_at, '%Y-%m'), '%Y-%m') AS month_at,
       strptime(strftime(ordered_at, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S') AS second_at FROM fct_orders""")(
    lambda cat: _o(cat).select("order_id", D.parse_timestamp(D.month_label("ordered_at"), "yyyy-MM").alias("month_at"),
                               D.parse_timestamp(F.date_format("ordered_at", "dd/MM/yyyy HH:mm:ss"), "dd/MM/yyyy HH:mm:ss").alias("second_at")))
