"""Command line: build the models as tables.

    python -m martlet run --out ROOT (--sf-dir DIR | --table name=path ...)
                          [--select a,b] [--full-refresh] [--as-of YYYY-MM-DD] [--user NAME]
                          [--price-min X] [--spend-min X] [--recent-days N]

``--sf-dir`` derives the source tables from the TPC-H-like test tables;
``--table`` maps each source name (fct_orders, dim_customers, order_items,
stg_mccp_prod_plan, f_sent_email_atvy, rls_user_auth_mast) to a stored
Parquet dataset.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from martlet.plans.params import Params
from martlet.plans.project import MODELS, run
from martlet.session import build_session
from martlet.sources.catalog import Catalog, fixture_catalog


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="martlet")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="materialise models")
    r.add_argument("--out", required=True)
    r.add_argument("--sf-dir")
    r.add_argument("--table", action="append", default=[], help="source=path")
    r.add_argument("--select", help=f"comma list of {', '.join(MODELS)}")
    r.add_argument("--full-refresh", action="store_true")
    r.add_argument("--as-of")
    r.add_argument("--user", help="default: the session's user")
    r.add_argument("--price-min", type=float, default=Params.price_min)
    r.add_argument("--spend-min", type=float, default=Params.spend_min)
    r.add_argument("--recent-days", type=int, default=Params.recent_days)
    r.add_argument("--master", help="only for local runs, e.g. local[8]")
    a = ap.parse_args(argv)

    spark = build_session(a.master, app_name="martlet-run")
    if a.sf_dir:
        cat = fixture_catalog(spark, a.sf_dir)
    else:
        cat = Catalog.from_paths(spark, dict(t.split("=", 1) for t in a.table))
    params = Params(as_of=dt.date.fromisoformat(a.as_of) if a.as_of else None, user=a.user,
                    price_min=a.price_min, spend_min=a.spend_min, recent_days=a.recent_days)
    built = run(cat, a.out, a.select.split(",") if a.select else None, a.full_refresh, params)
    print(json.dumps(built))


if __name__ == "__main__":
    main()
