"""Declarative data tests.

``run_checks`` evaluates every ``not_null`` / ``accepted`` check of a table in
one aggregate pass (``count_if`` per check) and every ``unique`` check as one
grouped aggregate; the report has one row per check:
``table_name, column_name, test, failures``.

Failure counts follow the usual data-test conventions: ``not_null`` counts
NULL rows, ``accepted`` counts non-NULL rows outside the list (NULLs pass),
``unique`` counts non-NULL values that occur more than once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    column: str
    test: str  # "not_null" | "unique" | "accepted_values"
    values: tuple = field(default=())


def not_null(column: str) -> Check:
    return Check(column, "not_null")


def unique(column: str) -> Check:
    return Check(column, "unique")


def accepted(column: str, values: Sequence) -> Check:
    return Check(column, "accepted_values", tuple(values))


class DataTestFailure(RuntimeError):
    pass


def run_checks(df: DataFrame, checks: Sequence[Check], table_name: str = "") -> DataFrame:
    """All checks of a table: every row-level check in one aggregate over the table, and one
    grouped aggregate per ``unique`` check, on the typed column.  No row is multiplied, and
    a key held by many rows is one record per task before its shuffle.
    """
    known = ("not_null", "accepted_values", "unique")
    unknown = [c for c in checks if c.test not in known]
    if unknown:
        raise ValueError(f"unknown tests {unknown}")

    def rows(c: Check):
        col = F.col(c.column)
        return F.count_if(col.isNull() if c.test == "not_null" else col.isNotNull() & ~col.isin(list(c.values)))

    def report(frame: DataFrame, c: Check, failures) -> DataFrame:
        return frame.select(F.lit(table_name).alias("table_name"), F.lit(c.column).alias("column_name"),
                            F.lit(c.test).alias("test"), failures.cast("long").alias("failures"))

    parts = []
    by_row = [c for c in checks if c.test != "unique"]
    if by_row:
        one = df.agg(*[rows(c).alias(f"c{i}") for i, c in enumerate(by_row)])
        parts.append(one.select(F.inline(F.array(*[F.struct(
            F.lit(table_name).alias("table_name"), F.lit(c.column).alias("column_name"),
            F.lit(c.test).alias("test"), F.col(f"c{i}").cast("long").alias("failures"))
            for i, c in enumerate(by_row)]))))
    for c in checks:
        if c.test == "unique":
            keys = df.filter(F.col(c.column).isNotNull()).groupBy(c.column).agg(F.count(F.lit(1)).alias("_n"))
            parts.append(report(keys.agg(F.count_if(F.col("_n") > 1).alias("_d")), c, F.col("_d")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gate(report: DataFrame, on_fail: str = "raise") -> list:
    """Stop a publish when any check failed.

    The report has one row per declared check (bounded), so collecting it is safe.
    Returns the failing rows when ``on_fail != "raise"``.
    """
    failing = report.filter(F.col("failures") > 0).collect()
    if failing and on_fail == "raise":
        lines = ", ".join(f"{r['table_name']}.{r['column_name']} {r['test']}={r['failures']}"
                          for r in failing)
        raise DataTestFailure(f"data tests failed: {lines}")
    return failing
