"""The two end-to-end flows (G1, G2), composed from the operators.

live:     station_information + station_status snapshots (JSON)
          -> bronze (incremental, exploded, lineage) and quarantine
          -> silver.latest_* (latest record per station, kept by keyed upsert)
          -> silver.stations (latest info LEFT JOIN latest status of the changed stations)
          -> gold.station_live_health -> tests -> gold.station_rebalancing_priority -> tests
history:  trip CSVs (year=/month=) -> bronze.trips (incremental) -> silver.trips
          (incremental cleaning) -> gold.hourly_trip_demand, monthly state of the touched months
          -> gold.station_monthly_flow -> tests

Each step reads only tables written by the previous one; a failing data test
stops the flow before anything downstream is published (D5).
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikelake.config import Config
from bikelake.operators.joins import current_state
from bikelake.operators.quality import gate, run_checks
from bikelake.operators.silver import latest_information, latest_status
from bikelake.operators.stations import rebalancing_queue, station_health
from bikelake.operators.trips import flow_of, flow_state, hourly_demand
from bikelake.plans.gold_tests import GOLD_TESTS
from bikelake.session import side_by_side
from bikelake.sinks.tables import (FROM_PROP, merge_buckets, rows_of_keys, switch, switch_buckets, table_props,
                                   upsert, write_version)
from bikelake.sources.schemas import STATION_INFORMATION, STATION_STATUS, TRIP_COLUMNS, all_strings
from bikelake.streaming.feeds import batch_ids, bronze_view, csv_table, ingest_csv, ingest_feed
from bikelake.streaming.ingest import clean_trips_stream

# Newest record first, by the columns that the latest records keep of the feeds' order.
INFO_STATE_ORDER = ["information_last_updated_at", "information_source_file"]
STATUS_STATE_ORDER = ["last_reported_at", "status_last_updated_at", "status_source_file"]
TRIP_DEPARTURES = dict(ts="started_at", id="start_station_id", name="start_station_name",
                       lat="start_lat", lng="start_lng")
TRIP_ARRIVALS = dict(ts="ended_at", id="end_station_id", name="end_station_name",
                     lat="end_lat", lng="end_lng")


def _published_and_tested(df: DataFrame, cfg: Config, model: str, tests, on_fail: str,
                          props: dict | None = None) -> str:
    """Write the next version, test it, and only then let readers see it."""
    name, spark = cfg.table("gold", model), df.sparkSession
    v, path = write_version(df, name, cfg.root)
    gate(run_checks(spark.read.parquet(path), tests, model), on_fail=on_fail)
    switch(spark, name, v, path, props=props)
    return name


def _changed_since(spark: SparkSession, feeds: dict, held: dict) -> DataFrame:
    """Ids of the stations that either feed's bronze batches after ``held`` name."""
    parts = [spark.table(f["bronze"]).filter(F.col("batch") > int(held.get(FROM_PROP + k, -1)))
             .select("station_id").distinct() for k, f in feeds.items()]
    return parts[0].union(parts[1]).distinct()


def _advance_state(spark: SparkSession, cfg: Config, feed: dict) -> None:
    """Merge the bronze batches that the feed's latest-record state does not hold yet (ST5)."""
    held = table_props(spark, feed["state"])
    after = int(held.get(FROM_PROP + "bronze", -1))
    if held and feed["last"] <= after:
        return
    rows = spark.table(feed["bronze"]).filter(F.col("batch").between(after + 1, feed["last"]))
    upsert(feed["state"], feed["latest"](rows), ["station_id"], cfg.root, order_desc=feed["order"], null_keys="match",
           source_unique=True, props={FROM_PROP + "bronze": str(feed["last"])}, before=held)


def run_live(spark: SparkSession, cfg: Config, multi_line: bool = True, on_fail: str = "raise",
             multi_line_status: bool | None = None) -> dict:
    """Live flow; returns the names of the tables it wrote.

    Every run reads the new landed files, then the new bronze batches, then those buckets of the
    states, of silver and of health that hold a station of these batches; the queue's rank is
    over all stations, so it is built anew from health.  Each table remembers the last bronze
    batches it was made from, in the catalog change that shows its rows: a run that stops
    anywhere, or at a failing test, is caught up by the next one.
    """
    cfg.ensure_databases(spark)

    def feed(name, contract, latest, order) -> dict:
        lines = multi_line_status if name == "station_status" and multi_line_status is not None else multi_line
        path, store = cfg.data("bronze", name), cfg.schema_store("bronze", name)
        ingest_feed(spark, cfg.landing(name), contract, store, path, cfg.data("quarantine", name),
                    cfg.checkpoint("bronze", name), multi_line=lines)
        bronze = bronze_view(spark, cfg.table("bronze", name), store, path)
        state = {"bronze": bronze, "state": cfg.table("silver", "latest_" + name.removeprefix("station_")),
                 "latest": latest, "order": order, "last": max(batch_ids(spark, path), default=-1)}
        _advance_state(spark, cfg, state)
        return state

    of = {"station_information": (STATION_INFORMATION, latest_information, INFO_STATE_ORDER),
          "station_status": (STATION_STATUS, latest_status, STATUS_STATE_ORDER)}
    feeds = dict(zip(of, side_by_side(spark, *[partial(feed, name, *rest) for name, rest in of.items()])))
    info, status = feeds["station_information"], feeds["station_status"]
    silver, health = cfg.table("silver", "stations"), cfg.table("gold", "station_live_health")
    key, now = ["station_id"], {FROM_PROP + k: str(f["last"]) for k, f in feeds.items()}

    changed = _changed_since(spark, feeds, table_props(spark, health)).persist()
    try:
        stations = current_state(rows_of_keys(spark, info["state"], cfg.root, key, changed),
                                 rows_of_keys(spark, status["state"], cfg.root, key, changed))
        upsert(silver, stations.withColumn("_silver_updated_at", F.current_timestamp()), key, cfg.root,
               null_keys="match", source_unique=True, props=now)
        rows = station_health(rows_of_keys(spark, silver, cfg.root, key, changed))
        version, written, plan = merge_buckets(health, rows, key, cfg.root, null_keys="match", unique=True)
        # a station's rows are in one bucket: the written ones are tested, the others were
        tested = spark.read.parquet(*written.values()) if written else rows
        gate(run_checks(tested, GOLD_TESTS["station_live_health"], "station_live_health"), on_fail=on_fail)
        switch_buckets(spark, health, version, plan, props=now)
    finally:
        changed.unpersist()
    queue = _published_and_tested(rebalancing_queue(spark.table(health)), cfg,
                                  "station_rebalancing_priority",
                                  GOLD_TESTS["station_rebalancing_priority"], on_fail)
    return {"bronze_information": info["bronze"], "bronze_status": status["bronze"], "silver": silver,
            "health": health, "queue": queue}


def trip_schema():
    from pyspark.sql.types import IntegerType
    return all_strings(TRIP_COLUMNS, {"year": IntegerType(), "month": IntegerType()})


def _advance_months(spark: SparkSession, cfg: Config, trips: DataFrame, flow_table: str, state: str) -> int:
    """Bring the monthly state up to the last bronze batch; returns that batch.

    The state lies by the trip files' month.  Months that new batches bring rows of are built
    again from their part of silver and replaced; the other months' trips are not read.
    """
    path = cfg.data("bronze", "trips")
    last = max(batch_ids(spark, path), default=-1)
    after = int(table_props(spark, flow_table).get(FROM_PROP + "trips", -1))
    if last > after:
        months = (spark.read.parquet(f"{path}/rows").filter(F.col("batch") > after)
                  .select("year", "month").distinct().collect())       # one row per month
        touched = F.lit(False)
        for m in months:
            touched = touched | (F.col("year").eqNullSafe(m.year) & F.col("month").eqNullSafe(m.month))
        rows = trips.filter(touched)
        (flow_state(rows, rows, TRIP_DEPARTURES, TRIP_ARRIVALS, keys=["year", "month"])
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(state))
    return last


def run_history(spark: SparkSession, cfg: Config, mapping: DataFrame | None,
                on_fail: str = "raise", demand_tests=None) -> dict:
    """Historical flow; ``mapping`` is the canonical station dimension (``load_dim``)."""
    cfg.ensure_databases(spark)
    bronze, silver = cfg.table("bronze", "trips"), cfg.table("silver", "trips")
    parts = [f for f in trip_schema().fields if f.name not in TRIP_COLUMNS]
    ingest_csv(spark, cfg.landing("trips"), TRIP_COLUMNS, parts, cfg.data("bronze", "trips"),
               cfg.checkpoint("bronze", "trips"))
    csv_table(spark, bronze, TRIP_COLUMNS, parts, cfg.data("bronze", "trips"))
    clean_trips_stream(spark, bronze, cfg.checkpoint("silver", "trips"),
                       path=cfg.data("silver", "trips"), table=silver, partition_by=("year", "month"))
    trips = spark.table(silver)
    flow_table, state = cfg.table("gold", "station_monthly_flow"), cfg.data("gold", "_monthly_state")
    last = _advance_months(spark, cfg, trips, flow_table, state)
    demand = _published_and_tested(hourly_demand(trips), cfg, "hourly_trip_demand",
                                   demand_tests or GOLD_TESTS["hourly_trip_demand"], on_fail)
    months = spark.read.parquet(state).drop("year", "month") if last >= 0 else flow_state(
        trips, trips, TRIP_DEPARTURES, TRIP_ARRIVALS)
    flow = _published_and_tested(flow_of(months, mapping), cfg, "station_monthly_flow",
                                 GOLD_TESTS["station_monthly_flow"], on_fail, {FROM_PROP + "trips": str(last)})
    return {"bronze": bronze, "silver": silver, "demand": demand, "flow": flow}
