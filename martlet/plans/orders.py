"""The six order models (J1-J6) and their variants.

Each model is a function ``(catalog, params) -> DataFrame``. Only single values and lists of bounded size reach
the driver while one is built (the run's day, hot keys, rank offsets per part). Shapes are chosen for very large fact tables:

* aggregate before joining whenever that shrinks the rows (per customer
  before attaching names, per order before attaching customers);
* join order follows the keys so consecutive joins share one partitioning;
* dimensions are never force-broadcast - AQE decides from measured sizes;
* ranks use the range-partitioned ``rank_within`` instead of one window task
  per month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.dates import day_of, days_ago, month_label, month_start
from martlet.operators.aggregates import count_when
from martlet.operators.joins import lookup, semi, skew_split_lookup, strict_lookup
from martlet.operators.ranking import rank_within
from martlet.operators.setops import union_distinct, unpivot_measures
from martlet.plans.params import Params, resolve_as_of, resolve_run_ts
from martlet.sources.catalog import Catalog

MONEY = 2  # decimals kept for summed prices (inputs are cents)
HOT_KEY_SUPPORT = 0.01  # share of the facts from which a join key is handled as hot


def _orders(cat: Catalog) -> DataFrame:
    return cat.table("fct_orders")


def _customers(cat: Catalog) -> DataFrame:
    return cat.table("dim_customers")


def _items(cat: Catalog) -> DataFrame:
    return cat.table("order_items")


# ---------------------------------------------------------------- J1
def orders_with_customer(cat: Catalog, params: Params = Params(), strict: bool = False) -> DataFrame:
    """Every order with its customer's name (NULL when unknown).

    ``strict=True`` is the scalar-subquery form (D12): a duplicated customer
    key raises instead of duplicating orders. Otherwise customers holding at
    least 1 % of the orders are spread over several tasks
    (``skew_split_lookup``).
    """
    o = _orders(cat).select("order_id", "customer_id", "order_total", "ordered_at")
    if strict:
        out = strict_lookup(o, _customers(cat), "customer_id", "name", "customer_name")
    else:
        out = skew_split_lookup(o, _customers(cat), "customer_id", {"name": "customer_name"}, "left",
                                support=HOT_KEY_SUPPORT)
    return out.select("order_id", "customer_id", "customer_name", "order_total", "ordered_at")


# ---------------------------------------------------------------- J2 / J9
def _spend_per_customer(cat: Catalog) -> DataFrame:
    return (_orders(cat).groupBy("customer_id")
            .agg(F.sum("order_total").alias("_spent"), F.max("ordered_at").alias("_last")))


def spend_per_customer_name(cat: Catalog, params: Params = Params(), how: str = "left",
                            unknown_label: str | None = None) -> DataFrame:
    """J2 (how='left'): total spend per customer name, orders of unknown
    customers in one NULL-named group, largest first.

    J9 variants: ``how='inner'`` drops unknown customers; ``unknown_label``
    names the NULL group (``COALESCE(name, 'Unknown')``).
    Orders are summed per customer id first (partial aggregation), so the
    name join sees one row per customer, not one per order.
    """
    named = lookup(_spend_per_customer(cat), _customers(cat), "customer_id", {"name": "customer_name"}, how)
    name = F.col("customer_name")
    if unknown_label is not None:
        name = F.coalesce(name, F.lit(unknown_label))
    return (named.groupBy(name.alias("customer_name"))
            .agg(F.round(F.sum("_spent"), MONEY).alias("total_spent"))
            .orderBy(F.col("total_spent").desc()))


def spend_and_last_order(cat: Catalog, params: Params = Params()) -> DataFrame:
    """Spend and latest order per known customer (grain = customer id)."""
    per = _spend_per_customer(cat)
    return (lookup(per, _customers(cat), "customer_id", {"name": "customer_name"}, "inner")
            .select("customer_name", F.round("_spent", MONEY).alias("total_spent"),
                    F.col("_last").alias("last_order_date"))
            .orderBy(F.col("total_spent").desc()))


# ---------------------------------------------------------------- J3 / J10
def _recent_order_items(cat: Catalog, params: Params) -> DataFrame:
    as_of = resolve_as_of(cat, params)
    # DATE(ts) >= d is rewritten by Catalyst into ts >= TIMESTAMP(d),
    # which reaches the Parquet scan as a pushed filter.
    recent = (_orders(cat).where(day_of("ordered_at") >= days_ago(F.lit(as_of), params.recent_days))
              .select("order_id", "ordered_at"))
    return (_items(cat).select("order_id", "product_id", "product_price")
            .join(recent, "order_id", "inner"))


def recent_products(cat: Catalog, params: Params = Params()) -> DataFrame:
    """Distinct (product, price, order time) ordered in the last N days."""
    return _recent_order_items(cat, params).select("product_id", "product_price", "ordered_at").distinct()


def recent_products_all(cat: Catalog, params: Params = Params()) -> DataFrame:
    """J3 without de-duplication (one row per ordered item)."""
    return _recent_order_items(cat, params).select("product_id", "product_price", "ordered_at")


# ---------------------------------------------------------------- J4 / J11
FOOD, DRINK = "food", "drink"


def _type_counts_per_order(cat: Catalog) -> DataFrame:
    """One row per order with food / drink item counts (E2, E5). Of an item's id only whether it has one is needed, so ids that
    can't be null are neither made nor shuffled."""
    food, drink = F.col("is_food_item") == 1, F.col("is_drink_item") == 1
    oi = _items(cat).where(food | drink).select("order_id", food.alias("_food"), drink.alias("_drink"),
                                                F.col("order_item_id").isNotNull().alias("_has_id"))
    food, drink, has_id = F.col("_food"), F.col("_drink"), F.col("_has_id")
    return (oi.groupBy("order_id")
            .agg(count_when(food & has_id).alias("food_count"),
                 count_when(food).alias("food_rows"),
                 count_when(drink & has_id).alias("drink_count"),
                 count_when(drink).alias("drink_rows")))


def _type_counts_unpivot(per_key: DataFrame, ids: list[str]) -> DataFrame:
    """H3: (ids, food, drink) -> rows (ids, item_count, item_type); a key
    with no item of a type has no row for it, as in the two-branch form."""
    long = unpivot_measures(
        per_key.select(*ids,
                       F.when(F.col("food_rows") > 0, F.col("food_count")).alias("_food"),
                       F.when(F.col("drink_rows") > 0, F.col("drink_count")).alias("_drink")),
        ids, {"_food": FOOD, "_drink": DRINK}, "item_count", "item_type")
    return long.where(F.col("item_count").isNotNull()).select(*ids, "item_count", "item_type")


def item_type_counts(cat: Catalog, params: Params = Params()) -> DataFrame:
    """J4 one-pass form: items per customer name and type (food / drink).

    Items are counted per order, orders rolled up per customer id, names
    attached last (one row per customer), then unpivoted. An item flagged
    both food and drink counts in both.
    """
    per_order = _type_counts_per_order(cat)
    per_cust = (per_order.join(_orders(cat).select("order_id", "customer_id"), "order_id")
                .groupBy("customer_id").agg(*[F.sum(c).alias(c) for c in
                                              ("food_count", "food_rows", "drink_count", "drink_rows")]))
    per_name = (per_cust.join(_customers(cat).select("customer_id", "name"), "customer_id")
                .groupBy("name").agg(*[F.sum(c).alias(c) for c in
                                       ("food_count", "food_rows", "drink_count", "drink_rows")]))
    return _type_counts_unpivot(per_name, ["name"])


def item_type_counts_two_branch(cat: Catalog, params: Params = Params()) -> DataFrame:
    """J4 base form (H1): one join + aggregate per type, then UNION (distinct)."""
    def branch(flag: str, label: str) -> DataFrame:
        j = (_customers(cat).join(_orders(cat), "customer_id").join(_items(cat), "order_id")
             .where(F.col(flag) == 1))
        return (j.groupBy("name").agg(F.count("order_item_id").alias("item_count"))
                .select("name", "item_count", F.lit(label).alias("item_type")))
    return union_distinct([branch("is_food_item", FOOD), branch("is_drink_item", DRINK)])


def item_type_counts_by_day(cat: Catalog, params: Params = Params()) -> DataFrame:
    """J4 per customer name and order day (UNION ALL of the two types)."""
    per_order = _type_counts_per_order(cat)
    o = _orders(cat).select("order_id", "customer_id", day_of("ordered_at").alias("order_date"))
    per_cust_day = (per_order.join(o, "order_id")
                    .groupBy("customer_id", "order_date")
                    .agg(*[F.sum(c).alias(c) for c in ("food_count", "food_rows", "drink_count", "drink_rows")]))
    per_name_day = (per_cust_day.join(_customers(cat).select("customer_id", "name"), "customer_id")
                    .groupBy("name", "order_date")
                    .agg(*[F.sum(c).alias(c) for c in ("food_count", "food_rows", "drink_count", "drink_rows")]))
    return _type_counts_unpivot(per_name_day, ["name", "order_date"]) \
        .select("name", "item_count", "item_type", "order_date")


# ---------------------------------------------------------------- J5 / J12
def high_value_customers(cat: Catalog, params: Params = Params()) -> DataFrame:
    """Customers whose total order value exceeds ``spend_min``."""
    return (_orders(cat).groupBy("customer_id").agg(F.sum("order_total").alias("_spent"))
            .where(F.col("_spent") > params.spend_min).select("customer_id"))


def _expensive_items_of_high_value(cat: Catalog, params: Params) -> DataFrame:
    items = (_items(cat).where(F.col("product_price") > params.price_min)
             .select("order_id", "product_id", "product_price"))
    rows = items.join(_orders(cat).select("order_id", "customer_id", "ordered_at"), "order_id")
    rows = semi(rows, high_value_customers(cat, params), "customer_id")
    # The rows of a customer who holds a large share of them are spread over tasks.
    return skew_split_lookup(rows, _customers(cat), "customer_id", {"name": "name"}, "inner",
                             support=HOT_KEY_SUPPORT, hot_from=_orders(cat))


def expensive_items_of_high_value(cat: Catalog, params: Params = Params()) -> DataFrame:
    """Items over ``price_min`` bought by customers over ``spend_min``."""
    return _expensive_items_of_high_value(cat, params).select("name", "product_id", "product_price")


def expensive_items_of_high_value_detail(cat: Catalog, params: Params = Params()) -> DataFrame:
    """J5 plus customer id and order day (D11 shape)."""
    return _expensive_items_of_high_value(cat, params).select(
        "name", "customer_id", "product_id", "product_price", day_of("ordered_at").alias("order_date"))


def expensive_items_of_high_value_loaded(cat: Catalog, params: Params = Params()) -> DataFrame:
    """J12 (load form): J5 plus customer id and the run's load timestamp."""
    return _expensive_items_of_high_value(cat, params).select(
        "name", "customer_id", "product_id", "product_price", resolve_run_ts(params).alias("created_at"))


# ---------------------------------------------------------------- J6 / J13 / J14
def _item_revenue_rows(cat: Catalog) -> DataFrame:
    return (_items(cat).select("order_id", "product_id", "product_price")
            .join(_orders(cat).select("order_id", "ordered_at"), "order_id"))


def monthly_product_rank(cat: Catalog, params: Params = Params()) -> DataFrame:
    """Revenue per (month 'yyyy-MM', product), ranked within the month."""
    agg = (_item_revenue_rows(cat)
           .groupBy(month_label("ordered_at").alias("order_month"), "product_id")
           .agg(F.round(F.sum("product_price"), MONEY).alias("total_revenue")))
    return rank_within(agg, ["order_month"], "total_revenue", "rank")


def daily_product_rank_in_month(cat: Catalog, params: Params = Params()) -> DataFrame:
    """Revenue per (day, product), ranked within the month."""
    agg = (_item_revenue_rows(cat)
           .groupBy(month_label("ordered_at").alias("order_month"),
                    day_of("ordered_at").alias("order_date"), "product_id")
           .agg(F.round(F.sum("product_price"), MONEY).alias("total_revenue")))
    return rank_within(agg, ["order_month"], "total_revenue", "rank")


def monthly_product_rank_dated(cat: Catalog, params: Params = Params()) -> DataFrame:
    """J6 with the month as a DATE (first day of month)."""
    agg = (_item_revenue_rows(cat)
           .groupBy(month_start("ordered_at").alias("order_month"), "product_id")
           .agg(F.round(F.sum("product_price"), MONEY).alias("total_revenue")))
    return rank_within(agg, ["order_month"], "total_revenue", "rank")
