"""Gold-model queries on the test tables: demand cube, monthly flow, entity
resolution, station health, rebalancing queue, global rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikelake.functions.clean import normalize_id
from bikelake.operators.rank import global_rank
from bikelake.operators.stations import HEALTH_COLUMNS, rebalancing_queue, station_health
from bikelake.operators.trips import hourly_demand, monthly_flow, monthly_side
from bikelake.plans.catalog import query
from bikelake.session import scratch_path
from bikelake.sources.files import load_dim
from bikelake.sources.tables import load_table


def station_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical mapping derived from the data: id ``<nationkey>`` -> its region.

    Ids 0..24 map five-to-one onto region keys, every other id is unmapped and
    falls back to itself — the shape of the station seed (many ids -> one key).
    """
    n = load_table(spark, sf, "nation")
    r = load_table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        normalize_id(F.col("n_nationkey").cast("string")).alias("station_id"),
        F.lower("r_name").alias("canonical_station_key"),
        F.col("r_name").alias("canonical_station_name"),
    )


MAPPING_SQL = """
    select cast(n_nationkey as varchar) as station_id, lower(r_name) as canonical_station_key,
           r_name as canonical_station_name
    from nation join region on n_regionkey = r_regionkey"""


def departure_rows(spark: SparkSession, sf: str) -> DataFrame:
    o = load_table(spark, sf, "orders")
    c = load_table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderdate", F.col("o_custkey").cast("string").alias("dep_id"), "c_name",
        "c_acctbal", "o_totalprice")


def arrival_rows(spark: SparkSession, sf: str) -> DataFrame:
    li = load_table(spark, sf, "lineitem")
    s = load_table(spark, sf, "supplier")
    return li.join(s, li.l_suppkey == s.s_suppkey).select(
        "l_shipdate", F.col("l_suppkey").cast("string").alias("arr_id"), "s_name",
        "l_extendedprice", "l_discount")


DEP = dict(ts="o_orderdate", id="dep_id", name="c_name", lat="c_acctbal", lng="o_totalprice")
ARR = dict(ts="l_shipdate", id="arr_id", name="s_name", lat="l_extendedprice", lng="l_discount")

SIDE_SQL = """
    select cast(year({ts}) as integer) as ride_year, cast(month({ts}) as integer) as ride_month,
           coalesce(m.canonical_station_key, t.{id}) as station_key,
           max(coalesce(m.canonical_station_name, t.{name})) as station_name,
           cast(round(cast(avg(t.{lat}) as decimal(28,10)), 6) as double) as station_lat,
           cast(round(cast(avg(t.{lng}) as decimal(28,10)), 6) as double) as station_lng,
           count(*) as {count_as}
    from ({rows}) t left join mapping m on t.{id} = m.station_id
    where t.{id} is not null and trim(t.{id}) != ''
    group by all"""

_DEP_ROWS = """select o_orderdate, cast(o_custkey as varchar) as dep_id, c_name, c_acctbal, o_totalprice
               from orders join customer on o_custkey = c_custkey"""
_ARR_ROWS = """select l_shipdate, cast(l_suppkey as varchar) as arr_id, s_name, l_extendedprice, l_discount
               from lineitem join supplier on l_suppkey = s_suppkey"""

DEPARTURES_SQL = SIDE_SQL.format(rows=_DEP_ROWS, count_as="departures", **DEP)
ARRIVALS_SQL = SIDE_SQL.format(rows=_ARR_ROWS, count_as="arrivals", **ARR)


@query("hourly_demand", sql="""
    select cast(ts as date) as ride_date, cast(year(ts) as integer) as ride_year,
           cast(month(ts) as integer) as ride_month, dayname(ts) as day_of_week,
           cast(hour(ts) as integer) as ride_hour, event_type,
           count(*) as total_trips,
           cast(round(cast(avg(value) as decimal(28,10)), 2) as double) as avg_ride_duration_minutes
    from events group by all""")
def q_hourly_demand(spark: SparkSession, sf: str) -> DataFrame:
    ev = load_table(spark, sf, "events")
    return hourly_demand(ev, ts="ts", segments=["event_type"], measure="value")


@query("monthly_departures", sql=f"with mapping as ({MAPPING_SQL}) {DEPARTURES_SQL}")
def q_monthly_departures(spark: SparkSession, sf: str) -> DataFrame:
    return monthly_side(departure_rows(spark, sf), "o_orderdate", "dep_id", "c_name",
                        "c_acctbal", "o_totalprice", mapping=station_mapping(spark, sf),
                        count_as="departures")


def flow_sql(mapping_sql: str, departures_sql: str, arrivals_sql: str) -> str:
    """DuckDB statement of the monthly flow: both sides matched on station and month (a NULL
    month matches nothing), absent counts are 0, descriptive values come from the side that
    has them, departures first."""
    return f"""
    with mapping as ({mapping_sql}),
    dep as ({departures_sql}),
    arr as ({arrivals_sql}),
    flow as (
      select * replace (ifnull(departures, 0) as departures, ifnull(arrivals, 0) as arrivals)
      from dep full join (select ride_year, ride_month, station_key, station_name as n2,
                                 station_lat as lat2, station_lng as lng2, arrivals from arr) as other
        using (ride_year, ride_month, station_key))
    select concat(ride_year::varchar, '|', lpad(ride_month::varchar, 2, '0'), '|', station_key) as station_month_key,
           ride_year, ride_month, station_key, ifnull(station_name, n2) as station_name,
           ifnull(station_lat, lat2) as station_lat, ifnull(station_lng, lng2) as station_lng,
           departures, arrivals, departures + arrivals as total_station_activity, arrivals - departures as net_flow
    from flow"""


_FLOW_SQL = flow_sql(MAPPING_SQL, DEPARTURES_SQL, ARRIVALS_SQL)


@query("monthly_flow", sql=_FLOW_SQL)
def q_monthly_flow(spark: SparkSession, sf: str) -> DataFrame:
    return monthly_flow(departure_rows(spark, sf), arrival_rows(spark, sf),
                        station_mapping(spark, sf), DEP, ARR)


@query("entity_resolution", sql=f"""
    with mapping as ({MAPPING_SQL})
    select s_suppkey, cast(s_suppkey as varchar) as station_id,
           coalesce(m.canonical_station_key, cast(s_suppkey as varchar)) as station_key,
           coalesce(m.canonical_station_name, s_name) as station_name
    from supplier left join mapping m on cast(s_suppkey as varchar) = m.station_id""")
def q_entity_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """Seed load (S9) + lookup (J2): the mapping is written as a seed CSV, read
    back with an explicit string schema, checked unique and broadcast by size."""
    from bikelake.operators.trips import resolve_entity
    seed = scratch_path(spark, "seed")
    station_mapping(spark, sf).coalesce(1).write.option("header", True).csv(seed)
    dim = load_dim(spark, seed, "station_id string, canonical_station_key string, "
                                "canonical_station_name string")
    s = load_table(spark, sf, "supplier").withColumn(
        "station_id", normalize_id(F.col("s_suppkey").cast("string")))
    j = resolve_entity(s, dim, "station_id", "s_name")
    return j.select("s_suppkey", "station_id", "station_key", "station_name")


# The supplier stand-in has no silver audit column.
SUPPLIER_HEALTH = [c for c in HEALTH_COLUMNS if c != "_silver_updated_at"]


def supplier_stations(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers shaped as stations; measures are conditional counts of their lineitems."""
    li = load_table(spark, sf, "lineitem")
    c = F.col
    m = li.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("capacity"),
        F.count_if(c("l_discount").isin(0.0, 0.1)).alias("num_bikes_available"),
        F.count_if(c("l_tax").isin(0.0, 0.08)).alias("num_docks_available"),
        F.count_if(c("l_discount").isin(0.0, 0.1) & (c("l_returnflag") == "R")).alias("num_ebikes_available"),
        F.count_if((c("l_returnflag") == "R") & (c("l_linestatus") == "O")).alias("num_bikes_disabled"),
        F.count_if((c("l_returnflag") == "A") & (c("l_linestatus") == "O")).alias("num_docks_disabled"),
        F.max(F.when(c("l_linestatus") == "O", 1).otherwise(0)).alias("is_renting"),
        F.max(F.when(c("l_linestatus") == "F", 1).otherwise(0)).alias("is_returning"),
        F.max("l_shipdate").alias("last_reported_at"),
        F.min("l_shipdate").alias("status_last_updated_at"),
    )
    s = load_table(spark, sf, "supplier").select(
        c("s_suppkey").alias("_k"),
        c("s_suppkey").cast("string").alias("station_id"),
        c("s_name").alias("address"), c("s_acctbal").alias("lat"),
        c("s_nationkey").cast("double").alias("lon"),
        F.when(c("s_acctbal") >= 0, 1).otherwise(0).alias("is_installed"))
    return s.join(m, s._k == m.l_suppkey, "left").drop("_k", "l_suppkey")


_SUPPLIER_CTES = """
    li as (
      select l_suppkey, count(*) as capacity,
             cast(count_if(l_discount in (0.0, 0.1)) as bigint) as num_bikes_available,
             cast(count_if(l_tax in (0.0, 0.08)) as bigint) as num_docks_available,
             cast(count_if(l_discount in (0.0, 0.1) and l_returnflag = 'R') as bigint) as num_ebikes_available,
             cast(count_if(l_returnflag = 'R' and l_linestatus = 'O') as bigint) as num_bikes_disabled,
             cast(count_if(l_returnflag = 'A' and l_linestatus = 'O') as bigint) as num_docks_disabled,
             max(case when l_linestatus = 'O' then 1 else 0 end) as is_renting,
             max(case when l_linestatus = 'F' then 1 else 0 end) as is_returning,
             max(l_shipdate) as last_reported_at, min(l_shipdate) as status_last_updated_at
      from lineitem group by l_suppkey),
    st as (
      select cast(s_suppkey as varchar) as station_id, s_name as address, s_acctbal as lat,
             cast(s_nationkey as double) as lon,
             case when s_acctbal >= 0 then 1 else 0 end as is_installed,
             li.* exclude (l_suppkey)
      from supplier left join li on s_suppkey = l_suppkey)"""

# One row per class that needs work: action, level, and either a fixed score or the share that
# is taken from 90 (fixed values of the queue model).
QUEUE_TAIL = """
    rules(health_status, recommended_action, priority_level, fixed_score, share) as (values
      ('NO_BIKES', 'ADD_BIKES', 'CRITICAL', 100.0, null),
      ('NO_DOCKS', 'REMOVE_BIKES', 'CRITICAL', 100.0, null),
      ('OUT_OF_SERVICE', 'INVESTIGATE', 'HIGH', 95.0, null),
      ('LOW_BIKES', 'ADD_BIKES', 'MEDIUM', null, 'bike'),
      ('LOW_DOCKS', 'REMOVE_BIKES', 'MEDIUM', null, 'dock')),
    scored as (
      select h.*, recommended_action, priority_level,
        ifnull(fixed_score::double, (90 - map {'bike': bike_availability_pct, 'dock': dock_availability_pct}[share]
                                          ::decimal(10,2))::double) as priority_score
      from h join rules using (health_status))
    select cast(row_number() over (order by priority_score desc nulls last, capacity desc nulls last,
                                   station_id asc nulls first) as bigint) as priority_rank,
           station_id, address, lat, lon, capacity, num_bikes_available, num_docks_available,
           bike_availability_pct::double as bike_availability_pct,
           dock_availability_pct::double as dock_availability_pct,
           num_bikes_disabled, num_docks_disabled, health_status, priority_level,
           priority_score, recommended_action,
           is_renting, is_returning, last_reported_at, status_last_updated_at
    from scored"""

# Health model over a CTE named ``st`` (station rows with measures).
HEALTH_CTES = """
    hm as (
      select *,
        case when capacity > 0 then ((num_bikes_available * 20000 + capacity) // (2 * capacity)) / 100.0 end
          as bike_availability_pct,
        case when capacity > 0 then ((num_docks_available * 20000 + capacity) // (2 * capacity)) / 100.0 end
          as dock_availability_pct,
        coalesce(num_bikes_disabled, 0) + coalesce(num_docks_disabled, 0) as disabled_assets
      from st),
    h as (
      select *, ifnull(list_filter(list_zip(
          [is_installed = 0 or is_renting + is_returning = 0, num_bikes_available = 0, num_docks_available = 0,
           bike_availability_pct <= 10, dock_availability_pct <= 10],
          ['OUT_OF_SERVICE', 'NO_BIKES', 'NO_DOCKS', 'LOW_BIKES', 'LOW_DOCKS']), lambda r: r[1])[1][2],
        'HEALTHY') as health_status   -- the first rule that holds
      from hm)"""

HEALTH_SELECT = """station_id, address, lat, lon, capacity, num_bikes_available, num_ebikes_available,
           num_bikes_disabled, num_docks_available, num_docks_disabled,
           cast(bike_availability_pct as double) as bike_availability_pct,
           cast(dock_availability_pct as double) as dock_availability_pct,
           disabled_assets, is_installed, is_renting, is_returning, health_status,
           last_reported_at, status_last_updated_at"""

_STATIONS_SQL = _SUPPLIER_CTES + ",\n" + HEALTH_CTES


@query("station_health", sql=f"""
    with {_STATIONS_SQL}
    select {HEALTH_SELECT}
    from h""")
def q_station_health(spark: SparkSession, sf: str) -> DataFrame:
    return station_health(supplier_stations(spark, sf), columns=SUPPLIER_HEALTH)


@query("rebalancing_queue", sql="with " + _STATIONS_SQL + ",\n" + QUEUE_TAIL)
def q_rebalancing_queue(spark: SparkSession, sf: str) -> DataFrame:
    return rebalancing_queue(station_health(supplier_stations(spark, sf), columns=SUPPLIER_HEALTH))


@query("global_rank", sql="""
    select *, cast(row_number() over (order by s_acctbal desc nulls last, s_nationkey desc nulls last,
                                      s_suppkey asc nulls first) as bigint) as priority_rank
    from supplier""")
def q_global_rank(spark: SparkSession, sf: str) -> DataFrame:
    s = load_table(spark, sf, "supplier")
    order = [F.col("s_acctbal").desc(), F.col("s_nationkey").desc(), F.col("s_suppkey").asc()]
    return global_rank(s, order, name="priority_rank")
