"""Sources, sinks and streams on the test tables: publish / upsert, partitioned
landing, feed lookup, bronze snapshot and trip streams, silver stream,
incremental current state.

Every query writes into a fresh folder under the shared checkpoint folder
(``spark.checkpoint.dir``) and returns a batch read of what it wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)

from bikelake.functions.clean import round_decimal
from bikelake.operators.silver import clean_trips
from bikelake.plans import derive
from bikelake.plans.bind_profile import SNAPSHOT_CUT
from bikelake.plans.catalog import query
from bikelake.session import scratch_path
from bikelake.sinks.landing import JSON_TS_FORMAT, land_snapshots, read_landed
from bikelake.sinks.tables import publish, upsert
from bikelake.sources.files import feed_url
from bikelake.sources.schemas import DISCOVERY, STATION_STATUS, TRIP_COLUMNS, all_strings, remembered_schema
from bikelake.sources.tables import load_table
from bikelake.streaming.feeds import bronze_view, ingest_csv, ingest_feed
from bikelake.streaming.ingest import clean_trips_stream, ingest_snapshots, ingest_trips
from bikelake.streaming.state import incremental_state

# CSV writer/reader options that keep values byte-exact (blanks, empty strings).
CSV_EXACT = {"header": "true", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}


def unique_name(prefix: str) -> str:
    return f"bl_{prefix}_{uuid.uuid4().hex[:10]}"


def user_totals(ev: DataFrame) -> DataFrame:
    return ev.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.max("ts").alias("last_event_at"),
        round_decimal(F.sum("value"), 2).alias("total_value"))


_TOTALS_SQL = """select user_id, count(*) as n_events, max(ts) as last_event_at,
                 cast(round(cast(sum(value) as decimal(28,10)), 2) as double) as total_value
                 from events {where} group by user_id"""


@query("upsert_first_load", sql=_TOTALS_SQL.format(where=""))
def q_upsert_first_load(spark: SparkSession, sf: str) -> DataFrame:
    """K2: the first publish creates the table; read back through the catalog."""
    name = unique_name("first")
    publish(user_totals(load_table(spark, sf, "events")), name, scratch_path(spark, "tables"))
    return spark.table(name)


@query("upsert_merge", sql=f"""
    with t as ({_TOTALS_SQL.format(where=f"where ts < timestamp '{SNAPSHOT_CUT}'")}),
         s as ({_TOTALS_SQL.format(where=f"where ts >= timestamp '{SNAPSHOT_CUT}'")})
    select coalesce(s.user_id, t.user_id) as user_id,
           case when s.user_id is not null then s.n_events else t.n_events end as n_events,
           case when s.user_id is not null then s.last_event_at else t.last_event_at end as last_event_at,
           case when s.user_id is not null then s.total_value else t.total_value end as total_value
    from t full outer join s on t.user_id = s.user_id""")
def q_upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    """K3 + J6: totals before the cut are the table, totals from the cut on are
    merged by ``user_id`` — twice, to show the merge is idempotent."""
    ev = load_table(spark, sf, "events")
    cut = F.lit(SNAPSHOT_CUT).cast("timestamp")
    name, root = unique_name("merge"), scratch_path(spark, "tables")
    publish(user_totals(ev.filter(F.col("ts") < cut)), name, root)
    source = user_totals(ev.filter(F.col("ts") >= cut))
    upsert(name, source, ["user_id"], root)
    upsert(name, source, ["user_id"], root)
    return spark.table(name)


@query("land_partitioned", sql="""
    select event_id, user_id, event_type, ts,
           cast(year(ts) as integer) as year, cast(month(ts) as integer) as month,
           cast(day(ts) as integer) as day
    from events""")
def q_land_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """K5: land events as JSON under year=/month=/day= (UTC), twice under one snapshot name (the
    second run replaces the first), and read them back with typed partition columns."""
    path = scratch_path(spark, "landing")
    ev = load_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    for _ in range(2):
        land_snapshots(ev, path, "ts", grain="day", snapshot="events-1")
    schema = StructType([StructField("event_id", LongType()),
                         StructField("ts", TimestampType()),
                         StructField("user_id", LongType()), StructField("event_type", StringType())])
    return read_landed(spark, path, schema, grain="day").select(
        "event_id", "user_id", "event_type", "ts", "year", "month", "day")


@query("feed_lookup", sql="""
    select s_suppkey // 5 as doc_id, cast(1704067200 as bigint) as last_updated,
           'https://feeds.example/' || s_name || '/' || cast(s_nationkey as varchar) || '.json' as url
    from supplier where s_suppkey % 5 = 2""")
def q_feed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Discovery documents (written as JSON, read with the contract) ->
    URL of the ``station_status`` feed in each."""
    path = scratch_path(spark, "discovery")
    derive.discovery_documents(load_table(spark, sf, "supplier")).write.json(path)
    docs = spark.read.schema(StructType([StructField("doc_id", LongType())] + list(DISCOVERY.fields))) \
        .json(path).drop("ttl")
    return feed_url(docs, "station_status")


# --- streams ---------------------------------------------------------------

STATUS_ELEMENT_SQL = """
    select cast(user_id as varchar) as station_id,
           cast(floor(value / 10) as bigint) as num_bikes_available,
           cast(floor(value) as bigint) % 3 as num_bikes_disabled,
           cast(floor(value) as bigint) % 7 as num_docks_available,
           event_id % 2 as num_docks_disabled,
           cast(floor(value / 20) as bigint) as num_ebikes_available,
           cast(0 as bigint) as num_scooters_available, cast(0 as bigint) as num_scooters_unavailable,
           case when event_type != 'error' then 'true' else 'false' end as is_installed,
           case when event_type = 'signup' then '0' else '1' end as is_renting,
           case when event_type in ('signup', 'view') then '0' else '1' end as is_returning,
           cast(floor(epoch(ts)) as bigint) as last_reported,
           -- event_id is not in the status contract: it is rescued, value as a string
           '{"event_id":"' || cast(event_id as varchar) || '"}' as _rescued_data,
           max(cast(floor(epoch(ts)) as bigint)) over (partition by cast(ts as date), event_id // 256)
             as last_updated,
           cast(60 as bigint) as ttl
    from events"""


def _write_status_docs(spark: SparkSession, sf: str, path: str) -> None:
    docs = derive.status_documents(load_table(spark, sf, "events")).drop("_day")
    # landed under day folders: the stream sees several files, one batch per few files
    land_snapshots(docs.withColumn("_ts", F.timestamp_seconds("last_updated")), path, "_ts",
                   grain="day", drop_ts=True)


@query("bronze_stream_explode", sql=STATUS_ELEMENT_SQL)
def q_bronze_stream_explode(spark: SparkSession, sf: str) -> DataFrame:
    """S1 P1 P2 K1 ST1 ST4: status snapshot documents -> incremental JSON stream ->
    explode ``data.stations`` + flatten + lineage -> checkpointed append."""
    base = scratch_path(spark, "bronze_status")
    _write_status_docs(spark, sf, f"{base}/in")
    ingest_snapshots(spark, f"{base}/in", STATION_STATUS, f"{base}/ckpt",
                     path=f"{base}/out", multi_line=False, max_files=16)
    cols = [f.name for f in STATION_STATUS.fields] + ["_rescued_data", "last_updated", "ttl"]
    return spark.read.parquet(f"{base}/out").select(*cols)


TRIP_ROWS_SQL = """
    select ts as _ts,
           ' R' || cast(event_id as varchar) as ride_id,
           case when event_id % 2 = 0 then ' Electric_Bike' else 'classic_bike ' end as rideable_type,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as started_at,
           strftime(make_timestamp(epoch_us(ts) + cast(floor(value * 60000000.0) as bigint)),
                    '%Y-%m-%d %H:%M:%S.%f') as ended_at,
           'W  ' || cast(user_id as varchar) || ' St' as start_station_name,
           ' ' || cast(user_id as varchar) || '.0' || cast(event_id % 10 as varchar)
             || repeat('_', cast(event_id % 3 as integer)) as start_station_id,
           ' E ' || cast(user_id % 50 as varchar) || chr(9) || 'Ave ' as end_station_name,
           cast((user_id + event_id) % 150 as varchar) || '.10' as end_station_id,
           printf('%.4f', value / 10.0) as start_lat,
           -- an empty CSV field reads back as NULL (the CSV null value is the empty string)
           case when event_type = 'error' then null else cast(user_id as varchar) end as start_lng,
           case when event_type = 'view' then 'n/a' else printf('%.2f', value) end as end_lat,
           cast(event_id as varchar) as end_lng,
           case when event_type in ('click', 'view') then ' Member' else 'casual' end as member_casual
    from events"""

TRIP_SCHEMA = all_strings(TRIP_COLUMNS, {"year": IntegerType(), "month": IntegerType()})


TRIP_PARTITIONS = [StructField("year", IntegerType()), StructField("month", IntegerType())]


def _land_trips(spark: SparkSession, sf: str, path: str) -> None:
    rows = derive.trip_rows(load_table(spark, sf, "events"))
    land_snapshots(rows, path, "_ts", grain="month", fmt="csv", drop_ts=True, **CSV_EXACT)


@query("trips_csv_stream", sql=f"""
    select * exclude (_ts), cast(year(_ts) as integer) as year, cast(month(_ts) as integer) as month,
           case when cast(trim(ride_id)[2:] as bigint) % 2 = 1
                then '{{"surcharge":"' || trim(ride_id)[2:] || '"}}' end as _rescued_data
    from ({TRIP_ROWS_SQL})""")
def q_trips_csv_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Trip CSVs under year=/month= folders, half of them with their columns in
    another order and one more column -> files read by header -> united by name, unknown
    column rescued, partition columns typed, lineage -> one folder per batch."""
    base = scratch_path(spark, "bronze_trips")
    rows = derive.trip_rows(load_table(spark, sf, "events"))
    odd = F.substring(F.trim("ride_id"), 2, 20).cast("long") % 2 == 1
    later = rows.filter(odd).select("_ts", F.substring(F.trim("ride_id"), 2, 20).alias("surcharge"),
                                    *reversed(TRIP_COLUMNS))
    for part in (rows.filter(~odd), later):
        land_snapshots(part, f"{base}/in", "_ts", grain="month", fmt="csv", drop_ts=True, **CSV_EXACT)
    ingest_csv(spark, f"{base}/in", TRIP_COLUMNS, TRIP_PARTITIONS, f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out/rows").select(*TRIP_COLUMNS, "year", "month", "_rescued_data")


@query("ingest_lineage", sql="""
    select 'year=' || strftime(ts, '%Y') || '/month=' || strftime(ts, '%m') as folder, count(*) as trips,
           cast(0 as bigint) as unaudited, cast(1 as bigint) as audit_times
    from events group by 1""")
def q_ingest_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Where the rows of bronze come from (``_source_file``), and that each has the audit
    time of its batch."""
    base = scratch_path(spark, "lineage")
    _land_trips(spark, sf, f"{base}/in")
    ingest_csv(spark, f"{base}/in", TRIP_COLUMNS, TRIP_PARTITIONS, f"{base}/out", f"{base}/ckpt")
    rows = spark.read.parquet(f"{base}/out/rows")
    return rows.groupBy(F.regexp_extract("_source_file", r"(year=\d+/month=\d+)/[^/]+$", 1).alias("folder")).agg(
        F.count(F.lit(1)).alias("trips"), F.count_if(F.col("_ingested_at").isNull()).alias("unaudited"),
        F.count_distinct("_ingested_at").alias("audit_times"))


_FAULTY_SQL = """
    with e as (
      select event_id, user_id, ts, event_id // 256 as blk,
             cast(cast(ts as date) as varchar) || '/' || cast(event_id // 256 as varchar) as doc
      from events)
    select case when blk % 11 = 5 then 'document' else 'envelope' end as reason,
           case when blk % 11 = 5 then doc
                when blk % 3 = 0 then '{"doc":"' || doc || '","ttl":"soon"}'
                else '{"doc":"' || doc || '"}' end as content,
           cast(null as bigint) as ttl
    from (select distinct blk, doc from e)
    union all
    select case when event_id % 50 = 0 then 'element' else 'row' end,
           case when event_id % 50 = 0 then cast(event_id as varchar)
                else cast(user_id as varchar) || '@' || cast(cast(floor(epoch(ts)) as bigint) as varchar) end,
           case when event_id % 50 <> 0 and blk % 3 <> 0 then 60 end
    from e where blk % 11 <> 5"""


@query("feed_quarantine", sql=_FAULTY_SQL)
def q_feed_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Status documents with a new envelope key, some truncated, with a mistyped envelope
    value or with elements that are no objects -> bronze rows, everything else quarantined."""
    base = scratch_path(spark, "quarantine")
    derive.faulty_status_texts(load_table(spark, sf, "events")).write.text(f"{base}/in")
    ingest_feed(spark, f"{base}/in", STATION_STATUS, f"{base}/contract", f"{base}/bronze", f"{base}/quarantine",
                f"{base}/ckpt", multi_line=False, max_files=16)
    rows = spark.table(bronze_view(spark, unique_name("faulty"), f"{base}/contract", f"{base}/bronze"))
    bad = spark.read.parquet(f"{base}/quarantine")
    # a truncated document is kept as it is: shown here by its label
    content = F.when(F.col("reason") == "document", F.regexp_extract("content", '"doc":"([^"]*)"', 1)).otherwise(F.col("content"))
    return bad.select("reason", content.alias("content"), F.lit(None).cast("long").alias("ttl")).unionByName(
        rows.select(F.lit("row").alias("reason"), F.concat_ws("@", "station_id", F.col("last_reported").cast("string")).alias("content"), "ttl"))


@query("feed_evolution", sql=f"""
    with s as ({STATUS_ELEMENT_SQL.replace("as last_reported,", "as last_reported, event_id, ts,", 1)})
    select station_id, num_bikes_available, is_installed, last_reported,
           case when last_updated >= epoch(timestamp '{SNAPSHOT_CUT}') then event_id end as event_id, last_updated
    from s""")
def q_feed_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """A feed that gains a field.  Documents before the cut lack ``event_id``, the later ones
    have it: the second run makes it a column of the next contract version, and bronze, read
    through the union of both versions, shows NULL in the old rows."""
    base = scratch_path(spark, "evolution")
    docs = derive.status_documents(load_table(spark, sf, "events"))
    cut = F.unix_seconds(F.lit(SNAPSHOT_CUT).cast("timestamp"))
    without = F.transform(F.col("data.stations"), lambda e: e.dropFields("event_id"))
    old = docs.filter(F.col("last_updated") < cut).withColumn("data", F.struct(without.alias("stations")))
    name = unique_name("evolving")
    for part in (old, docs.filter(F.col("last_updated") >= cut)):
        part.drop("_day").write.mode("append").json(f"{base}/in")
        ingest_feed(spark, f"{base}/in", STATION_STATUS, f"{base}/contract", f"{base}/bronze", f"{base}/quarantine",
                    f"{base}/ckpt", multi_line=False)
        bronze_view(spark, name, f"{base}/contract", f"{base}/bronze")
    return spark.table(name).select("station_id", "num_bikes_available", "is_installed", "last_reported", "event_id",
                                    "last_updated")


@query("remembered_schema", sql=f"""
    select user_id, case when ts >= timestamp '{SNAPSHOT_CUT}' then value else floor(value) end as value,
           case when ts >= timestamp '{SNAPSHOT_CUT}' then event_type else cast(event_id as varchar) end as label,
           case when ts >= timestamp '{SNAPSHOT_CUT}' then event_id end as event_id
    from events""")
def q_remembered_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Types inferred from a feed's first files are remembered; later files widen them
    (``value`` long to double, ``label`` long to string) and add a field.  All files read
    through the remembered contract."""
    base = scratch_path(spark, "remembered")
    ev = load_table(spark, sf, "events")
    cut = F.lit(SNAPSHOT_CUT).cast("timestamp")
    ev.filter(F.col("ts") < cut).select("user_id", F.floor("value").alias("value"), F.col("event_id").alias("label")) \
        .write.json(f"{base}/in/run=1")
    remembered_schema(spark, f"{base}/in/run=1", f"{base}/contract")
    ev.filter(F.col("ts") >= cut).select("user_id", "value", F.col("event_type").alias("label"), "event_id") \
        .write.json(f"{base}/in/run=2")
    _, schema = remembered_schema(spark, f"{base}/in/run=2", f"{base}/contract")
    return spark.read.schema(schema).json([f"{base}/in/run=1", f"{base}/in/run=2"]) \
        .select("user_id", "value", "label", "event_id")


def _regex_id(c: str) -> str:
    return (f"regexp_replace(regexp_replace(regexp_replace(trim({c}), '_+$', ''), "
            f"'(\\.\\d*?[1-9])0+$', '\\1'), '\\.0+$', '')")


def _trip_name(c: str) -> str:
    return (f"regexp_replace(regexp_replace(trim({c}), '\\s+', ' ', 'g'), "
            f"'\\b([NSEW])\\s+(\\d+)\\b', '\\1\\2', 'g')")


SILVER_TRIPS_SQL = f"""
    select trim(ride_id) as ride_id, lower(trim(rideable_type)) as rideable_type,
           try_cast(started_at as timestamp) as started_at, try_cast(ended_at as timestamp) as ended_at,
           {_trip_name('start_station_name')} as start_station_name,
           {_regex_id('start_station_id')} as start_station_id,
           {_trip_name('end_station_name')} as end_station_name,
           {_regex_id('end_station_id')} as end_station_id,
           try_cast(start_lat as double) as start_lat, try_cast(start_lng as double) as start_lng,
           try_cast(end_lat as double) as end_lat, try_cast(end_lng as double) as end_lng,
           lower(trim(member_casual)) as member_casual,
           round((floor(epoch(try_cast(ended_at as timestamp))) - floor(epoch(try_cast(started_at as timestamp))))
                 / 60.0, 2) as ride_duration_minutes,
           cast(year(_ts) as integer) as year, cast(month(_ts) as integer) as month
    from ({TRIP_ROWS_SQL})"""

SILVER_TRIP_COLUMNS = [c for c in TRIP_COLUMNS] + ["ride_duration_minutes", "year", "month"]


def bronze_trips_table(spark: SparkSession, sf: str, base: str) -> str:
    """Land trip CSVs and ingest them into a catalog bronze table; returns its name."""
    name = unique_name("bronze_trips")
    _land_trips(spark, sf, f"{base}/in")
    ingest_trips(spark, f"{base}/in", TRIP_SCHEMA, f"{base}/ckpt_bronze",
                 path=f"{base}/bronze", table=name)
    return name


@query("silver_stream", sql=SILVER_TRIPS_SQL)
def q_silver_stream(spark: SparkSession, sf: str) -> DataFrame:
    """S8 ST3: the bronze trips table read as a stream -> ``clean_trips`` -> append.
    The result equals ``clean_trips`` applied to the same rows in batch."""
    base = scratch_path(spark, "silver_trips")
    bronze = bronze_trips_table(spark, sf, base)
    clean_trips_stream(spark, bronze, f"{base}/ckpt_silver", path=f"{base}/silver")
    return spark.read.parquet(f"{base}/silver").select(*SILVER_TRIP_COLUMNS)


@query("silver_batch", sql=SILVER_TRIPS_SQL)
def q_silver_batch(spark: SparkSession, sf: str) -> DataFrame:
    """ST3 batch twin of ``silver_stream``: the same transform on a static read."""
    base = scratch_path(spark, "silver_batch")
    _land_trips(spark, sf, f"{base}/in")
    raw = spark.read.schema(TRIP_SCHEMA).options(**CSV_EXACT).csv(f"{base}/in")
    return clean_trips(raw).select(*SILVER_TRIP_COLUMNS)


@query("incremental_current_state", sql="""
    select user_id, event_id, ts, event_type, value
    from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def q_incremental_current_state(spark: SparkSession, sf: str) -> DataFrame:
    """ST5: events replayed as daily files, one file per micro-batch; each batch is
    reduced to the latest row per user and merged into a versioned table guarded
    by the ordering keys.  Equals the full recompute (``latest_info``)."""
    base = scratch_path(spark, "state")
    ev = load_table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    land_snapshots(ev, f"{base}/in", "ts", grain="day")
    schema = StructType([StructField("user_id", LongType()), StructField("event_id", LongType()),
                         StructField("ts", TimestampType()),
                         StructField("event_type", StringType()),
                         StructField("value", DoubleType())])
    stream = (spark.readStream.schema(schema).option("timestampFormat", JSON_TS_FORMAT)
              .option("maxFilesPerTrigger", 1).json(f"{base}/in"))
    name = unique_name("state")
    incremental_state(stream, name, f"{base}/tables", ["user_id"], ["ts", "event_id"],
                      f"{base}/ckpt", buckets=4)
    return spark.table(name).select("user_id", "event_id", "ts", "event_type", "value")
