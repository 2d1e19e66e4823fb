"""Registry of runnable queries: key -> (job, oracle SQL).

models, ``d03_...`` for single operators). A job takes a ``Catalog`` and
returns a lazy DataFrame over whole tables; the oracle statement computes the
same result in DuckDB from the raw driver tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from martlet.oracle import with_fixtures
from martlet.sources.catalog import Catalog

Job = Callable[[Catalog], DataFrame]

JOBS: dict[str, Job] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: Job) -> Job:
        if key in JOBS:
            raise ValueError(f"duplicate query key {key}")
        JOBS[key] = fn
        if oracle is not None:
            ORACLE[key] = with_fixtures(oracle)
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from martlet.plans import queries_incremental, queries_maintained, queries_models, queries_operators  # noqa: F401
