"""The models as a project: build every model as a stored table (``run``).

Each model is paired with the materialisation its source declares: a table
(full refresh into a new committed version, A3) with a layout (A4-A11), or
an incremental target refreshed by its own job (J15-J17). ``run`` builds
the selected models in order; each is one or a few Spark jobs over whole
tables, and nothing passes through the driver but marks and metadata.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from martlet.plans import email_activity as EM
from martlet.plans import incremental_models as IM
from martlet.plans import orders as M
from martlet.plans import sales_plan as SP
from martlet.plans.params import Params, resolve_as_of
from martlet.sources.catalog import Catalog
from martlet.sources.sinks import Layout, full_refresh, read_table
from martlet.sources.target import IncrementalConfig, Target

Build = Callable[[Catalog, Params], DataFrame]
Refresh = Callable[[Catalog, Target, Params, bool], None]


@dataclass(frozen=True)
class Model:
    name: str
    build: Build | None = None                 # table models
    layout: Layout = Layout()
    refresh: Refresh | None = None             # incremental models
    config: IncrementalConfig | None = None

    @property
    def incremental(self) -> bool:
        return self.refresh is not None


def _recent(cat: Catalog, target: Target, params: Params, full: bool) -> None:
    IM.refresh_recent_products(cat, target, resolve_as_of(cat, params), full_refresh=full)


MODELS: dict[str, Model] = {m.name: m for m in [
    Model("orders_with_customer", refresh=lambda c, t, p, f: IM.refresh_orders_with_customer(c, t, f),
          config=IM.ORDERS_WITH_CUSTOMER),
    Model("spend_per_customer", build=M.spend_and_last_order,
          layout=Layout(partition_field="last_order_date", partition_kind="day",
                        cluster_by=("customer_name",))),
    Model("recent_products", refresh=_recent, config=IM.RECENT_PRODUCTS),
    Model("item_type_counts", build=M.item_type_counts,
          layout=Layout(partition_field="item_type", partition_kind="value", cluster_by=("name",))),
    Model("high_value_purchases", build=M.expensive_items_of_high_value_detail,
          layout=Layout(partition_field="customer_id", partition_kind="range",
                        range_start=0, range_end=None, range_interval=10_000,
                        cluster_by=("customer_id",))),
    Model("monthly_product_rank", refresh=lambda c, t, p, f: IM.refresh_monthly_rank(c, t, f),
          config=IM.MONTHLY_RANK),
    Model("sales_call_plan", build=SP.sales_call_plan,
          layout=Layout(even=True, sort_by=("year", "ciclo", "terr", "product_name_vod__c"))),
    Model("email_activity", build=EM.email_activity,
          layout=Layout(distribute_by="terr_id", sort_by=("prod_nm",))),
]}


def model_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def run(cat: Catalog, root: str, select: list[str] | None = None, full: bool = False,
        params: Params = Params()) -> dict[str, str]:
    """Materialise the selected models (all by default) under ``root``."""
    done: dict[str, str] = {}
    for name in select or list(MODELS):
        m = MODELS[name]
        path = model_path(root, name)
        if m.incremental:
            m.refresh(cat, Target(cat.spark, path, m.config), params, full)
        else:
            full_refresh(m.build(cat, params), path, m.layout)
        done[name] = path
    return done


def read_model(cat: Catalog, root: str, name: str, params: Params = Params()) -> DataFrame | None:
    """The stored content of a model (None for an incremental model before its
    first rows). A table version without rows reads as an empty table of the
    model's schema (taken from its lazily built plan)."""
    m = MODELS[name]
    path = model_path(root, name)
    if m.incremental:
        return Target(cat.spark, path, m.config).read()
    return read_table(cat.spark, path, schema=m.build(cat, params).schema)
