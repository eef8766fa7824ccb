"""Query catalogue: name -> (query(spark, sf_dir) -> DataFrame, oracle SQL).

Queries read the driver's tables (through ``riskloom.fixtures``) so their
work grows with the data; the oracle SQL is independent text that DuckDB
runs on the same parquet tables, with the fixture views inlined as CTEs.
Parameters that would otherwise make a result time-dependent (as_of,
operation_time, updated_at) are pinned here.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

# Pinned parameters
AS_OF = dt.date(2024, 1, 30)
OPERATION_TIME = dt.datetime(2024, 2, 2, 6, 0, 0)
UPDATED_AT = dt.datetime(2024, 2, 1, 0, 0, 0)
CALIBRATION = "20240201"
LOOKBACK_AS_OF = dt.date(2024, 1, 20)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _load_all() -> None:
    # importing the modules fills REGISTRY
    from riskloom.plans import (q_relational, q_reshape, q_mutation, q_sources,  # noqa: F401
                                q_jobs)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


# SQL helpers shared by the oracle texts
PD_LIST = ", ".join(f"PD_{i}" for i in range(1, 61))


def pd_list(prefix: str = "") -> str:
    return ", ".join(f"{prefix}PD_{i}" for i in range(1, 61))


LATEST_SQL = ("SELECT * FROM pd_raw QUALIFY row_number() OVER (PARTITION BY data_date, company_id "
              "ORDER BY operation_time DESC) = 1")
