"""The declared data tests of the four gold models, run on what the two flows published."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikelake.config import Config
from bikelake.operators.quality import DataTestFailure, not_null, run_checks, unique
from bikelake.plans.bind_flows import DEMAND_SQL, FLOW_SQL, HEALTH_SQL, QUEUE_SQL, history_tables, live_tables
from bikelake.plans.catalog import query
from bikelake.plans.bind_profile import SNAPSHOT_CUT
from bikelake.plans.flows import _published_and_tested
from bikelake.plans.gold_tests import GOLD_TESTS, checks_sql
from bikelake.session import scratch_path, side_by_side
from bikelake.sources.tables import load_table

_MODEL_SQL = {"hourly_trip_demand": DEMAND_SQL, "station_monthly_flow": FLOW_SQL,
              "station_live_health": HEALTH_SQL, "station_rebalancing_priority": QUEUE_SQL}


@query("dq_suite", sql="\nunion all\n".join(checks_sql(sql, GOLD_TESTS[m], m) for m, sql in _MODEL_SQL.items()))
def q_dq_suite(spark: SparkSession, sf: str) -> DataFrame:
    """All declared tests of the four gold models, one report over the published tables."""
    history, live = side_by_side(spark, partial(history_tables, spark, sf), partial(live_tables, spark, sf))
    tables = {"hourly_trip_demand": history["demand"], "station_monthly_flow": history["flow"],
              "station_live_health": live["health"], "station_rebalancing_priority": live["queue"]}
    out = None
    for model, name in tables.items():
        report = run_checks(spark.table(name), GOLD_TESTS[model], model)
        out = report if out is None else out.unionByName(report)
    return out


@query("publish_gate", sql=f"""
    select event_id, user_id, 'gate_gold.events' as published_as, 'unique' as stopped_by
    from events where ts < timestamp '{SNAPSHOT_CUT}'""")
def q_publish_gate(spark: SparkSession, sf: str) -> DataFrame:
    """D5 ST2 G3: a version that fails its tests is never shown.  The events before the cut are
    published; the version with all events holds some ids twice, so it is stopped, and readers
    of the table, named by the environment, still see the first one."""
    cfg = Config(catalog=f"mobility_gate{uuid.uuid4().hex[:8]}", root=scratch_path(spark, "gate"))
    cfg.ensure_databases(spark)
    ev = load_table(spark, sf, "events").select("event_id", "user_id", "ts")
    tests = [not_null("event_id"), unique("event_id")]
    name = _published_and_tested(ev.filter(F.col("ts") < F.lit(SNAPSHOT_CUT).cast("timestamp")), cfg, "events", tests, "raise")
    twice = ev.unionByName(ev.filter("event_id % 7 = 0"))
    try:
        _published_and_tested(twice, cfg, "events", tests, "raise")
        stopped = "nothing"
    except DataTestFailure as e:
        stopped = "unique" if "event_id unique=" in str(e) and "not_null" not in str(e) else str(e)
    return spark.table(name).select("event_id", "user_id", F.lit(name.replace(cfg.env, "gate")).alias("published_as"),
                                    F.lit(stopped).alias("stopped_by"))
