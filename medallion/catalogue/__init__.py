"""Registered queries (one per operator id group) and their DuckDB oracles.

Every query reads the driver tables (through the derived fixtures) over
their whole extent.  Oracles are written in the reference's literal shape
(UNION ALL of home and away rows, self-join to the latest row, single global
window), so the distributed rewrites are checked against the unoptimised form.
Columns carrying ``current_timestamp`` are never returned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _load():
    # Importing the modules registers their queries.
    from . import gold_q, silver_q, quality_q, snapshot_q, dashboard_q, file_q  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
