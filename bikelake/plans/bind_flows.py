"""End-to-end runs of the live and historical flows on data derived from the
test tables (events -> status snapshots and trips, customers -> station
information, nation/region -> station mapping seed)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikelake.config import Config
from bikelake.plans import derive
from bikelake.plans.bind_gold import HEALTH_CTES, HEALTH_SELECT, QUEUE_TAIL, SIDE_SQL, flow_sql
from bikelake.plans.bind_io import CSV_EXACT, SILVER_TRIPS_SQL, STATUS_ELEMENT_SQL, _land_trips
from bikelake.plans.bind_profile import SNAPSHOT_CUT
from bikelake.plans.catalog import query
from bikelake.plans.flows import TRIP_ARRIVALS, TRIP_DEPARTURES, run_history, run_live
from bikelake.session import scratch_path, side_by_side
from bikelake.sinks.landing import land_snapshots
from bikelake.sources.files import load_dim
from bikelake.sources.tables import load_table


def _config(spark: SparkSession, what: str) -> Config:
    return Config(catalog=f"mobility_{what}{uuid.uuid4().hex[:8]}", root=scratch_path(spark, what))


def _land_docs(docs: DataFrame, path: str) -> None:
    env = docs.select("last_updated", "ttl", "version", "data")
    land_snapshots(env.withColumn("_ts", F.timestamp_seconds("last_updated")), path, "_ts",
                   grain="day", drop_ts=True)


_LIVE_CTES = f"""
    with se as ({STATUS_ELEMENT_SQL}),
    ls as (select * from se
           qualify row_number() over (partition by station_id order by last_reported desc, last_updated desc) = 1),
    inf as (
      select cast(c_custkey as varchar) as station_id,
             concat(' ', ['W','E','N','S'][c_custkey % 4 + 1], '  ', cast(c_nationkey as varchar), ' St & ',
                    c_mktsegment, ' ') as name,
             c_acctbal / 97.0 as lat, cast(c_nationkey * 1.5 as double) as lon, cast(c_nationkey + 5 as bigint) as capacity
      from customer),
    li as (
      select station_id, regexp_replace(trim(name), '\\b([NSEW])\\s+(\\d+)\\b', '\\1\\2', 'g') as address,
             round(lat, 6) as lat, round(lon, 6) as lon, capacity
      from inf),
    st as (
      select li.*, ls.num_bikes_available, ls.num_ebikes_available, ls.num_bikes_disabled,
             ls.num_docks_available, ls.num_docks_disabled,
             case when ls.is_installed = 'true' then 1 when ls.is_installed = 'false' then 0 end as is_installed,
             cast(ls.is_renting as integer) as is_renting, cast(ls.is_returning as integer) as is_returning,
             make_timestamp(ls.last_reported * 1000000) as last_reported_at,
             make_timestamp(ls.last_updated * 1000000) as status_last_updated_at
      from li left join ls on li.station_id = ls.station_id),
    {HEALTH_CTES},
    """


def live_tables(spark: SparkSession, sf: str) -> dict:
    cfg = _config(spark, "live")
    ev = load_table(spark, sf, "events")
    cust = load_table(spark, sf, "customer")
    side_by_side(spark,
                 lambda: _land_docs(derive.information_documents(cust), cfg.landing("station_information")),
                 lambda: _land_docs(derive.status_documents(ev), cfg.landing("station_status")))
    # Customers without events are stations without status: their not_null tests fail and
    # are reported; the flow goes on with all stations.
    return run_live(spark, cfg, multi_line=False, on_fail="report")


QUEUE_SQL = _LIVE_CTES + QUEUE_TAIL
HEALTH_SQL = _LIVE_CTES.rstrip().rstrip(",") + f"\n    select {HEALTH_SELECT} from h"


@query("live_end_to_end", sql=QUEUE_SQL)
def q_live_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """G1: snapshots landed as JSON -> two bronze streams -> silver current state
    (keyed upsert) -> health -> tests -> rebalancing queue -> tests."""
    return spark.table(live_tables(spark, sf)["queue"])


@query("live_health", sql=HEALTH_SQL)
def q_live_health(spark: SparkSession, sf: str) -> DataFrame:
    """G1: the health table that the live flow publishes, for all stations."""
    return spark.table(live_tables(spark, sf)["health"]).drop("_silver_updated_at")


@query("live_second_run", sql=HEALTH_SQL)
def q_live_second_run(spark: SparkSession, sf: str) -> DataFrame:
    """G1 ST5: the live flow run twice, the second time with the documents after the cut: it
    reads the new files and the changed stations only and gives the rows of a full build."""
    cfg = _config(spark, "again")
    docs = derive.status_documents(load_table(spark, sf, "events"))
    cut = F.unix_seconds(F.lit(SNAPSHOT_CUT).cast("timestamp"))
    _land_docs(derive.information_documents(load_table(spark, sf, "customer")), cfg.landing("station_information"))
    for part in (docs.filter(F.col("last_updated") < cut), docs.filter(F.col("last_updated") >= cut)):
        _land_docs(part, cfg.landing("station_status"))
        names = run_live(spark, cfg, multi_line=False, on_fail="report")
    return spark.table(names["health"]).drop("_silver_updated_at")


SEED_SQL = """
    select regexp_replace(regexp_replace(regexp_replace(cast(n_nationkey as varchar) || '.10', '_+$', ''),
                          '(\\.\\d*?[1-9])0+$', '\\1'), '\\.0+$', '') as station_id,
           lower(r_name) as canonical_station_key, r_name as canonical_station_name
    from nation join region on n_regionkey = r_regionkey"""


def _side(spec: dict, count_as: str) -> str:
    return SIDE_SQL.format(rows=SILVER_TRIPS_SQL, count_as=count_as, **spec)


FLOW_SQL = flow_sql(SEED_SQL, _side(TRIP_DEPARTURES, "departures"), _side(TRIP_ARRIVALS, "arrivals"))
DEMAND_SQL = f"""
    select cast(started_at as date) as ride_date, cast(year(started_at) as integer) as ride_year,
           cast(month(started_at) as integer) as ride_month, dayname(started_at) as day_of_week,
           cast(hour(started_at) as integer) as ride_hour, member_casual, rideable_type, count(*) as total_trips,
           cast(round(cast(avg(ride_duration_minutes) as decimal(28,10)), 2) as double) as avg_ride_duration_minutes
    from ({SILVER_TRIPS_SQL}) group by all"""


def history_tables(spark: SparkSession, sf: str) -> dict:
    cfg = _config(spark, "hist")
    _land_trips(spark, sf, cfg.landing("trips"))
    n = load_table(spark, sf, "nation")
    r = load_table(spark, sf, "region")
    seed = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.concat(F.col("n_nationkey").cast("string"), F.lit(".10")).alias("station_id"),
        F.lower("r_name").alias("canonical_station_key"), F.col("r_name").alias("canonical_station_name"))
    seed_path = cfg.landing("seeds/station_mapping")
    seed.write.options(**CSV_EXACT).csv(seed_path)
    mapping = load_dim(spark, seed_path, "station_id string, canonical_station_key string, "
                                         "canonical_station_name string")
    return run_history(spark, cfg, mapping)


@query("history_end_to_end", sql=FLOW_SQL)
def q_history_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Trip CSVs -> bronze batches -> silver cleaning stream -> demand + monthly
    flow (mapping seed CSV, ids normalised) -> tests; returns the published flow."""
    return spark.table(history_tables(spark, sf)["flow"])


@query("history_demand", sql=DEMAND_SQL)
def q_history_demand(spark: SparkSession, sf: str) -> DataFrame:
    """The demand cube that the historical flow publishes."""
    return spark.table(history_tables(spark, sf)["demand"])
