"""Query catalogue: every operator bound to the driver's test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  The test tables
hold no stations or trips, so each operator runs on a table of the same shape
(``events`` ~ trips / status feed, ``supplier``+``lineitem`` ~ stations with
measures, ``orders``/``lineitem`` ~ departures / arrivals, ``nation``+``region``
~ the canonical station mapping).  Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# Equivalent DuckDB SQL over the same parquet tables (absent = not SQL-expressible).
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def registry() -> tuple[dict, dict]:
    """Import every binding module (each registers its queries) and return
    ``(QUERIES, ORACLE_SQL)``."""
    from bikelake.plans import bind_flows, bind_gold, bind_io, bind_profile, bind_silver, bind_suite  # noqa: F401
    return QUERIES, ORACLE_SQL
