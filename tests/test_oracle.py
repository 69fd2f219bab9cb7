"""Every registered query against its DuckDB oracle (the driver's correctness gate).

Runs at ``$BIKELAKE_ORACLE_SF`` (default sf0.001 to keep the suite fast; the
gate itself is sf0.01: ``python tools/check.py /root/testdata/sf0.01``).
"""

import contextlib
import io
import os
import re

import pytest

import __spark_entry__ as E
from tests.compare import compare, duck

SF = os.environ.get("BIKELAKE_ORACLE_SF", "/root/testdata/sf0.001")
from bikelake.plans.catalog import registry  # the large-text queries have tests of their own

KEYS = sorted(registry()[1])


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_key_has_an_oracle():
    missing = set(KEYS) - set(E.oracle_sql())
    assert not missing, f"no oracle for {missing}"


# Plan nodes that must never appear: cross products, per-row / per-group Python.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]
WINDOW = re.compile(r"\(\d+\) Window\nInput \[\d+\]: \[(.*)\]\nArguments: (.*)")


def unpartitioned_windows(plan: str) -> list[str]:
    """Window nodes without PARTITION BY (they run in a single task), except the
    rank offsets, whose input is one row per partition (``_p, _n``)."""
    bad = []
    for inputs, args in WINDOW.findall(plan):
        partitioned = args.count("], [") >= 2
        offsets = [c.split("#")[0] for c in inputs.split(", ")] == ["_p", "_n"]
        if not partitioned and not offsets:
            bad.append(args[:120])
    return bad


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    ok, msg = compare(df, con, E.oracle_sql()[key])
    assert ok, f"{key}: {msg}"
    plan = plan_of(df)
    for node in FORBIDDEN:
        assert node not in plan, f"{key}: {node} in plan"
    assert not unpartitioned_windows(plan), f"{key}: unpartitioned window"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_trips" in df.columns


def test_queue_invariants(spark):
    """Scores stay inside their class range and ranks are a permutation of 1..n."""
    from pyspark.sql import functions as F
    q = E.queries()["rebalancing_queue"](spark, SF)
    rows = q.select("priority_rank", "health_status", "priority_score", "priority_level").collect()
    n = len(rows)
    assert sorted(r["priority_rank"] for r in rows) == list(range(1, n + 1))
    for r in rows:
        s, h = r["priority_score"], r["health_status"]
        if h in ("NO_BIKES", "NO_DOCKS"):
            assert s == 100.0 and r["priority_level"] == "CRITICAL"
        elif h == "OUT_OF_SERVICE":
            assert s == 95.0 and r["priority_level"] == "HIGH"
        else:
            assert 80.0 <= s <= 90.0 and r["priority_level"] == "MEDIUM"
    assert q.filter(F.col("health_status") == "HEALTHY").count() == 0
