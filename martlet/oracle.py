"""Independent SQL statements of every registered query, for DuckDB.

They run over the driver's raw tables, so each statement first rebuilds the
analytic tables it reads with the same fixed projection as
``martlet.sources.catalog.fixture_catalog`` (as CTEs). Only the CTEs a
statement mentions are emitted.
"""

from __future__ import annotations

# The fixture projection (FIXTURES.md), DuckDB dialect.
FIXTURE_CTES: dict[str, str] = {
    "fct_orders": """
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS order_total,
         o_orderdate AS ordered_at
  FROM orders""",
    "dim_customers": """
  SELECT c_custkey AS customer_id, c_name AS name FROM customer WHERE c_custkey % 50 <> 7""",
    "order_items": """
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' ||
         CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS order_item_id,
         l_orderkey AS order_id, l_partkey AS product_id, p_retailprice AS product_price,
         CASE WHEN p_type IN ('ECONOMY', 'LARGE', 'STANDARD') THEN 1 ELSE 0 END AS is_food_item,
         CASE WHEN p_type IN ('PROMO', 'SMALL', 'STANDARD') THEN 1 ELSE 0 END AS is_drink_item
  FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "stg_mccp_prod_plan": """
  SELECT 'MCCP-' || CAST(year(o_orderdate) AS VARCHAR) || '-' ||
         CASE WHEN o_orderkey % 17 = 0 THEN 'ES'
              ELSE 'C' || CAST((month(o_orderdate) + 3) // 4 AS VARCHAR) END || '_' ||
         CASE WHEN o_custkey % 5 = 0 THEN 'ESCRM0001NORTH' WHEN o_custkey % 5 = 1 THEN 'ESCSO0002PLUSNORTH'
              WHEN o_custkey % 5 = 2 THEN 'ESNORTH01CSO' WHEN o_custkey % 5 = 3 THEN 'ESCSO0003SOUTH'
              ELSE 'ESCSO0004' END || '_X' AS external_id_vod__c,
         'PROD' || CAST(o_orderkey % 4 AS VARCHAR) AS product_name_vod__c,
         strftime(CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 4 < 2 THEN -30 ELSE 30 END AS INTEGER),
                  '%Y-%m-%d') AS modified_date,
         o_orderdate AS systemmodstamp,
         CAST(o_orderkey % 13 + 1 AS DOUBLE) AS product_activity_goal_vod__c,
         CAST(o_orderkey % 9 AS DOUBLE) AS product_actual_activity_vod__c,
         CAST(o_orderkey % 6 AS DOUBLE) AS product_interactions_actual_vod__c,
         CAST(o_orderkey % 201 AS DOUBLE) / 2 AS product_attainment_vod__c,
         CASE o_orderkey % 3 WHEN 0 THEN 'ES_F2F' WHEN 1 THEN 'ES_S2S' ELSE 'ES_EMAIL' END AS channel_vod__c,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS last_activity_datetime_vod__c,
         CASE WHEN o_custkey % 11 = 0 THEN 'FRANCE' ELSE 'SPAIN' END AS ropu_nm
  FROM orders""",
    "f_sent_email_atvy": """
  SELECT 'PROD' || CAST(l_partkey % 5 AS VARCHAR) AS prod_nm,
         'ES' || CASE WHEN l_suppkey % 4 = 0 THEN 'CRM' ELSE 'CSO' END || CAST(l_suppkey % 8 AS VARCHAR) AS terr_id,
         CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE 'mail-' || CAST(l_orderkey AS VARCHAR) END AS sent_email_nm,
         CASE WHEN l_partkey % 10 = 0 THEN 'Failed_vod' ELSE 'Delivered_vod' END AS status,
         CASE WHEN l_linenumber > 3 THEN 1 ELSE 0 END AS opened,
         CASE WHEN l_linenumber > 5 THEN 1 ELSE 0 END AS clicked,
         l_linenumber AS open_count, CAST(trunc(l_quantity) AS INTEGER) % 3 AS click_count,
         l_shipdate AS email_sent_dt,
         CASE l_suppkey % 3 WHEN 0 THEN 'ES' WHEN 1 THEN 'FR' ELSE 'DE' END AS cntry_cd
  FROM lineitem""",
    "rls_user_auth_mast": """
  SELECT * FROM (VALUES ('analyst', 'ES'), ('analyst', 'FR'), ('admin', '')) t(uname, opu)""",
}


def with_fixtures(body: str) -> str:
    """Prefix ``body`` with the fixture CTEs it mentions."""
    used = [name for name in FIXTURE_CTES if name in body]
    if not used:
        return body
    ctes = ",\n".join(f"{name} AS ({FIXTURE_CTES[name]}\n)" for name in used)
    body = body.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
