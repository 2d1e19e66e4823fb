"""Run parameters that the reference takes from the environment
(CURRENT_DATE, CURRENT_USER, thresholds). The defaults are the reference's own
values; ``FIXTURE`` holds those that the registered queries use, whose test
tables have other prices and fixed dates."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import functions as F

from martlet.sources.catalog import Catalog

LAST_ORDER = "last order day"


@dataclass(frozen=True)
class Params:
    as_of: dt.date | str | None = None    # None = CURRENT_DATE(); LAST_ORDER = the latest order's day
    price_min: float = 20.0               # J5 item price threshold
    spend_min: float = 500.0              # J5 customer spend threshold
    user: str | None = None               # J8 row-level security; None = CURRENT_USER
    recent_days: int = 90                 # J3 look-back
    run_ts: dt.datetime | None = None     # CURRENT_TIMESTAMP() stamped on loaded rows


FIXTURE = Params(as_of=LAST_ORDER, price_min=950.0, spend_min=2_500_000.0, user="analyst")


def resolve_run_ts(params: Params):
    """The load timestamp: the ``run_ts`` parameter, else the session's clock."""
    return F.lit(params.run_ts).cast("timestamp_ntz") if params.run_ts is not None else F.localtimestamp()


def resolve_user(cat: Catalog, params: Params) -> str:
    """The user whose rights apply: the parameter, else the session's user."""
    return params.user if params.user is not None else cat.spark.sql("SELECT current_user() AS u").first()["u"]


def resolve_as_of(cat: Catalog, params: Params) -> dt.date:
    """``as_of``, the session's current date when unset, or the day of the latest order.

    One value crosses to the driver so later filters are literals that reach
    the Parquet scan as pushed filters.
    """
    if params.as_of is None:
        return cat.spark.sql("SELECT current_date() AS d").first()["d"]
    if params.as_of == LAST_ORDER:
        return cat.table("fct_orders").agg(F.max(F.to_date("ordered_at")).alias("d")).first()["d"]
    return params.as_of
