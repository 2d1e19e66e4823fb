"""Table catalog: logical model names -> lazily scanned DataFrames (A1, A2).

A model never names a file. It asks the catalog for ``fct_orders`` or for an
upstream model by name, and gets a DataFrame whose scan Catalyst can prune and
filter. Two ways to fill a catalog:

* ``Catalog.from_paths`` - stored Parquet datasets, one path per logical name;
* ``fixture_catalog`` - the six analytic tables derived from the driver's
  TPC-H-like tables by a fixed, deterministic projection (FIXTURES.md), so
  the same rows can be rebuilt by the SQL oracle.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TableFactory = Callable[[], DataFrame]


def name_parts(name: str) -> tuple[str, ...]:
    """The parts of a qualified name; dots inside backticks don't part."""
    return tuple(p.strip("`") for p in re.findall(r"`[^`]*`|[^.`]+", name))


class Catalog:
    def __init__(self, spark: SparkSession, tables: dict[str, TableFactory] | None = None,
                 sources: dict[tuple[str, str], str] | None = None):
        self.spark = spark
        self._tables: dict[str, TableFactory] = dict(tables or {})
        self._sources: dict[tuple[str, str], str] = dict(sources or {})

    # -- A1: stored tables by (qualified) name ----------------------------
    @classmethod
    def from_paths(cls, spark: SparkSession, paths: dict[str, str]) -> "Catalog":
        return cls(spark, {name: (lambda p=p: spark.read.parquet(p)) for name, p in paths.items()})

    def register(self, name: str, factory: TableFactory) -> None:
        self._tables[name] = factory

    def table(self, name: str) -> DataFrame:
        """The table of a name. A name with fewer parts than the registered one means the only table that ends in it; one with
        more parts means a table registered without them. Anything else is unknown."""
        asked = name_parts(name)
        known = {n: name_parts(n) for n in self._tables}
        longer = [n for n, p in known.items() if p[-len(asked):] == asked]
        exact = [n for n in longer if known[n] == asked]
        if len(exact or longer) > 1:
            raise KeyError(f"table {name!r} is one of {sorted(longer)}")
        shorter = sorted((n for n, p in known.items() if len(p) < len(asked) and asked[-len(p):] == p), key=lambda n: len(known[n]))
        found = exact or longer or shorter[-1:]
        if not found:
            raise KeyError(f"unknown table {name!r}; known: {sorted(self._tables)}")
        return self._tables[found[0]]()

    # -- A2: logical source / upstream model ------------------------------
    def declare_source(self, source_name: str, tables: dict[str, str]) -> None:
        """Say which tables a source has: its own table names -> names of this catalog."""
        self._sources |= {(source_name, t): n for t, n in tables.items()}

    def source(self, source_name: str, table_name: str) -> DataFrame:
        """A table of a declared source. A catalog without declared sources has but one, whatever its name."""
        if not self._sources:
            return self.table(table_name)
        if (source_name, table_name) not in self._sources:
            raise KeyError(f"source {source_name!r} has no table {table_name!r}; declared: {sorted(self._sources)}")
        return self.table(self._sources[source_name, table_name])

    def ref(self, model: str) -> DataFrame:
        return self.table(model)

    def with_filter(self, name: str, condition) -> "Catalog":
        """A copy in which table ``name`` only shows rows matching ``condition``
        (e.g. the source as it was at an earlier time)."""
        tables = dict(self._tables)
        base = tables[name]
        tables[name] = lambda: base().where(condition)
        return Catalog(self.spark, tables, self._sources)

    def with_table(self, name: str, df: DataFrame) -> "Catalog":
        """A copy in which ``name`` is the given DataFrame (e.g. one micro-batch)."""
        tables = dict(self._tables)
        tables[name] = lambda: df
        return Catalog(self.spark, tables, self._sources)

    def names(self) -> list[str]:
        return sorted(self._tables)

    def register_views(self) -> None:
        for name in self._tables:
            self.table(name).createOrReplaceTempView(name)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def fixture_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The analytic tables as projections of the driver tables (FIXTURES.md)."""

    def fct_orders() -> DataFrame:
        return _read(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_totalprice").alias("order_total"),
            F.col("o_orderdate").alias("ordered_at"))

    def dim_customers() -> DataFrame:
        # 2 % of customers are left out so that left / inner / NULL-group forms differ.
        return (_read(spark, sf_dir, "customer")
                .where(F.col("c_custkey") % 50 != 7)
                .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name")))

    def order_items() -> DataFrame:
        li = _read(spark, sf_dir, "lineitem")
        part = _read(spark, sf_dir, "part")
        # Fixed values of the fixture: part types flagged food / drink
        # (STANDARD is both, MEDIUM is neither).
        food_types = ["ECONOMY", "LARGE", "STANDARD"]
        drink_types = ["PROMO", "SMALL", "STANDARD"]
        return (li.join(part, li.l_partkey == part.p_partkey, "inner")
                .select(
                    F.concat_ws("-", _s(F.col("l_orderkey")), _s(F.col("l_linenumber")),
                                _s(F.col("l_partkey")), _s(F.col("l_suppkey"))).alias("order_item_id"),
                    F.col("l_orderkey").alias("order_id"),
                    F.col("l_partkey").alias("product_id"),
                    F.col("p_retailprice").alias("product_price"),
                    F.when(F.col("p_type").isin(food_types), 1).otherwise(0).alias("is_food_item"),
                    F.when(F.col("p_type").isin(drink_types), 1).otherwise(0).alias("is_drink_item")))

    def stg_mccp_prod_plan() -> DataFrame:
        o = _read(spark, sf_dir, "orders")
        k, c, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
        cycle = F.when(k % 17 == 0, F.lit("ES")).otherwise(
            F.concat(F.lit("C"), _s(F.floor((F.month(d) + 3) / 4))))
        # Fixed values of the fixture: territory codes by customer key modulo 5.
        terr = (F.when(c % 5 == 0, "ESCRM0001NORTH").when(c % 5 == 1, "ESCSO0002PLUSNORTH")
                .when(c % 5 == 2, "ESNORTH01CSO").when(c % 5 == 3, "ESCSO0003SOUTH")
                .otherwise("ESCSO0004"))
        return o.select(
            F.concat(F.lit("MCCP-"), _s(F.year(d)), F.lit("-"), cycle, F.lit("_"), terr,
                     F.lit("_X")).alias("external_id_vod__c"),
            F.concat(F.lit("PROD"), _s(k % 4)).alias("product_name_vod__c"),
            F.date_format(F.date_add(F.to_date(d), F.when(k % 4 < 2, -30).otherwise(30)),
                          "yyyy-MM-dd").alias("modified_date"),
            d.alias("systemmodstamp"),
            (k % 13 + 1).cast("double").alias("product_activity_goal_vod__c"),
            (k % 9).cast("double").alias("product_actual_activity_vod__c"),
            (k % 6).cast("double").alias("product_interactions_actual_vod__c"),
            ((k % 201).cast("double") / 2).alias("product_attainment_vod__c"),
            F.when(k % 3 == 0, "ES_F2F").when(k % 3 == 1, "ES_S2S").otherwise("ES_EMAIL")
             .alias("channel_vod__c"),
            F.when(k % 7 == 0, F.lit(None)).otherwise(d).alias("last_activity_datetime_vod__c"),
            F.when(c % 11 == 0, "FRANCE").otherwise("SPAIN").alias("ropu_nm"))

    def f_sent_email_atvy() -> DataFrame:
        li = _read(spark, sf_dir, "lineitem")
        pk, sk, ok, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey"), F.col("l_linenumber")
        return li.select(
            F.concat(F.lit("PROD"), _s(pk % 5)).alias("prod_nm"),
            F.concat(F.lit("ES"), F.when(sk % 4 == 0, "CRM").otherwise("CSO"), _s(sk % 8)).alias("terr_id"),
            F.when(pk % 19 == 0, F.lit(None)).otherwise(F.concat(F.lit("mail-"), _s(ok))).alias("sent_email_nm"),
            F.when(pk % 10 == 0, "Failed_vod").otherwise("Delivered_vod").alias("status"),
            F.when(ln > 3, 1).otherwise(0).alias("opened"),
            F.when(ln > 5, 1).otherwise(0).alias("clicked"),
            ln.alias("open_count"),
            (F.col("l_quantity").cast("int") % 3).alias("click_count"),
            F.col("l_shipdate").alias("email_sent_dt"),
            F.when(sk % 3 == 0, "ES").when(sk % 3 == 1, "FR").otherwise("DE").alias("cntry_cd"))

    def rls_user_auth_mast() -> DataFrame:
        # Fixed values of the fixture: user -> country grants ('' = every country).
        return spark.createDataFrame(
            [("analyst", "ES"), ("analyst", "FR"), ("admin", "")], "uname string, opu string")

    return Catalog(spark, {
        "fct_orders": fct_orders,
        "dim_customers": dim_customers,
        "order_items": order_items,
        "stg_mccp_prod_plan": stg_mccp_prod_plan,
        "f_sent_email_atvy": f_sent_email_atvy,
        "rls_user_auth_mast": rls_user_auth_mast,
    })
