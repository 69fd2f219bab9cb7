"""Silver-layer queries on the test tables: latest per key, current-state join,
cleaners, casts, time conversions, explode, rescued data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from bikelake.functions.clean import (clean_name, duration_minutes, epoch_to_ts,
                                      normalize_category, normalize_id, to_type)
from bikelake.operators.joins import current_state
from bikelake.operators.latest import latest_per_key
from bikelake.plans.catalog import query
from bikelake.sources.schemas import with_rescued
from bikelake.sources.tables import load_table


@query("latest_info", sql="""
    select user_id, event_id, ts as last_event_at, event_type as last_event_type, value
    from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def q_latest_info(spark: SparkSession, sf: str) -> DataFrame:
    """W1 + F1 + P4/P5: newest event per user, renamed, payload dropped."""
    ev = load_table(spark, sf, "events").drop("props")
    latest = latest_per_key(ev, ["user_id"], ["ts", "event_id"])
    return latest.withColumnsRenamed({"ts": "last_event_at", "event_type": "last_event_type"}) \
        .select("user_id", "event_id", "last_event_at", "last_event_type", "value")


_STATUS_SQL = """
    select user_id as station_id, value as num_bikes_available, event_type as last_event_type,
           event_id, ts as last_reported_at
    from events
    qualify row_number() over (partition by user_id
                               order by ts desc, value desc, event_id desc) = 1"""


def latest_user_status(spark: SparkSession, sf: str, method: str = "window") -> DataFrame:
    ev = load_table(spark, sf, "events").select(
        F.col("user_id").alias("station_id"), F.col("value").alias("num_bikes_available"),
        F.col("event_type").alias("last_event_type"), "event_id",
        F.col("ts").alias("last_reported_at"))
    return latest_per_key(ev, ["station_id"], ["last_reported_at", "num_bikes_available", "event_id"],
                          method=method)


@query("latest_status", sql=_STATUS_SQL)
def q_latest_status(spark: SparkSession, sf: str) -> DataFrame:
    """Three descending ordering keys, ``row_number`` form."""
    return latest_user_status(spark, sf, method="window")


@query("current_state_join", sql=f"""
    with info as (
      select c_custkey as station_id, c_name as address, c_acctbal as capacity, c_nationkey as region_id
      from customer
      qualify row_number() over (partition by c_custkey order by c_acctbal desc, c_name desc) = 1),
    status as ({_STATUS_SQL})
    select info.*, status.* exclude (station_id)
    from info left join status on info.station_id = status.station_id""")
def q_current_state_join(spark: SparkSession, sf: str) -> DataFrame:
    """J1 over W1/W2: customers as station information, latest event as status.
    Customers without events keep NULL measures; users without a customer row are dropped."""
    c = load_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("station_id"), F.col("c_name").alias("address"),
        F.col("c_acctbal").alias("capacity"), F.col("c_nationkey").alias("region_id"))
    info = latest_per_key(c, ["station_id"], ["capacity", "address"])
    status = latest_user_status(spark, sf, method="aggregate")
    return current_state(info, status, "station_id")


@query("normalize_id", sql=r"""
    with t as (
      select l_orderkey, l_linenumber,
             concat(' ', cast(l_orderkey as varchar), '.', lpad(cast(l_linenumber * 10 as varchar), 3, '0'),
                    repeat('_', l_linenumber % 3), ' ') as raw_id,
             cast(l_quantity as varchar) as qty_raw, cast(l_tax as varchar) as tax_raw
      from lineitem)
    select l_orderkey, l_linenumber, raw_id,
           regexp_replace(regexp_replace(regexp_replace(trim(raw_id), '_+$', ''),
                          '(\.\d*?[1-9])0+$', '\1'), '\.0+$', '') as station_id,
           regexp_replace(regexp_replace(regexp_replace(trim(qty_raw), '_+$', ''),
                          '(\.\d*?[1-9])0+$', '\1'), '\.0+$', '') as qty_id,
           regexp_replace(regexp_replace(regexp_replace(trim(tax_raw), '_+$', ''),
                          '(\.\d*?[1-9])0+$', '\1'), '\.0+$', '') as tax_id
    from t""")
def q_normalize_id(spark: SparkSession, sf: str) -> DataFrame:
    """X1 on ids built from lineitem keys: trailing ``_``, redundant zeros, zero fractions."""
    li = load_table(spark, sf, "lineitem")
    raw = F.concat(F.lit(" "), F.col("l_orderkey").cast("string"), F.lit("."),
                   F.lpad((F.col("l_linenumber") * 10).cast("string"), 3, "0"),
                   F.repeat(F.lit("_"), F.col("l_linenumber") % 3), F.lit(" "))
    t = li.select("l_orderkey", "l_linenumber", raw.alias("raw_id"),
                  F.col("l_quantity").cast("string").alias("qty_raw"),
                  F.col("l_tax").cast("string").alias("tax_raw"))
    return t.select("l_orderkey", "l_linenumber", "raw_id",
                    normalize_id("raw_id").alias("station_id"),
                    normalize_id("qty_raw").alias("qty_id"),
                    normalize_id("tax_raw").alias("tax_id"))


_NAME_RAW = """concat('  ', case l_linenumber % 4 when 0 then 'W' when 1 then 'E' when 2 then 'N' else 'S' end,
                      repeat(' ', 1 + l_linenumber % 3), cast(l_suppkey as varchar), ' St &',
                      repeat(' ', 1 + l_linenumber % 2), case l_partkey % 3 when 0 then 'w' when 1 then 'NW' else 'E' end,
                      ' ', cast(l_linenumber as varchar), case l_partkey % 2 when 0 then 'nd' else '' end, ' Ave ')"""


@query("clean_name", sql=r"""
    with t as (select l_orderkey, l_linenumber, l_partkey, """ + _NAME_RAW + r""" as raw_name from lineitem)
    select 'lineitem' as src, l_orderkey as row_key, l_linenumber as line, raw_name,
           regexp_replace(regexp_replace(trim(raw_name), '\s+', ' ', 'g'), '\b([NSEW])\s+(\d+)\b', '\1\2', 'g')
             as trip_name,
           regexp_replace(trim(raw_name), '\b([NSEW])\s+(\d+)\b', '\1\2', 'g') as station_name
    from t
    union all
    select 'documents' as src, doc_id as row_key, cast(0 as integer) as line, md5(text) as raw_name,
           md5(regexp_replace(regexp_replace(trim(text), '\s+', ' ', 'g'), '\b([NSEW])\s+(\d+)\b', '\1\2', 'g'))
             as trip_name,
           md5(regexp_replace(trim(text), '\b([NSEW])\s+(\d+)\b', '\1\2', 'g')) as station_name
    from documents""")
def q_clean_name(spark: SparkSession, sf: str) -> DataFrame:
    """X2 (collapse whitespace + direction merge) and X3 (direction merge only) on
    built street names and on whole document texts (compared by md5)."""
    li = load_table(spark, sf, "lineitem")
    raw = F.expr(_NAME_RAW.replace("varchar", "string"))
    names = li.select(F.lit("lineitem").alias("src"), F.col("l_orderkey").alias("row_key"),
                      F.col("l_linenumber").alias("line"), raw.alias("raw_name"))
    names = names.select("src", "row_key", "line", "raw_name",
                         clean_name("raw_name", True).alias("trip_name"),
                         clean_name("raw_name", False).alias("station_name"))
    docs = load_table(spark, sf, "documents").select(
        F.lit("documents").alias("src"), F.col("doc_id").alias("row_key"), F.lit(0).alias("line"),
        F.md5("text").alias("raw_name"),
        F.md5(clean_name("text", True)).alias("trip_name"),
        F.md5(clean_name("text", False)).alias("station_name"))
    return names.unionByName(docs)


@query("normalize_category", sql="""
    select o_orderkey, lower(trim(concat('  ', o_orderpriority, ' '))) as rideable_type,
           lower(trim(o_orderstatus)) as member_casual
    from orders""")
def q_normalize_category(spark: SparkSession, sf: str) -> DataFrame:
    """``lower(trim(x))`` on padded categories."""
    o = load_table(spark, sf, "orders")
    return o.select("o_orderkey",
                    normalize_category(F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))).alias("rideable_type"),
                    normalize_category("o_orderstatus").alias("member_casual"))


@query("typed_casts", sql="""
    with t as (
      select l_orderkey, l_linenumber,
             case when l_linenumber = 1 then 'n/a' when l_linenumber = 2 then ''
                  else cast(cast(l_quantity as bigint) as varchar) end as qty_raw,
             case when l_linenumber = 3 then 'x' || cast(l_extendedprice as varchar)
                  else ' ' || cast(l_extendedprice as varchar) || ' ' end as price_raw,
             cast(l_shipdate as varchar) as ship_raw
      from lineitem)
    select l_orderkey, l_linenumber, try_cast(qty_raw as integer) as qty,
           try_cast(trim(price_raw) as double) as price,
           try_cast(ship_raw as timestamp) as shipped_at,
           cast(l_linenumber as bigint) as line_long
    from t""")
def q_typed_casts(spark: SparkSession, sf: str) -> DataFrame:
    """String -> int / double / timestamp with ``try_cast`` (bad input -> NULL), int -> long."""
    li = load_table(spark, sf, "lineitem")
    ln = F.col("l_linenumber")
    qty_raw = (F.when(ln == 1, "n/a").when(ln == 2, "")
               .otherwise(F.col("l_quantity").cast("long").cast("string")))
    price_raw = (F.when(ln == 3, F.concat(F.lit("x"), F.col("l_extendedprice").cast("string")))
                 .otherwise(F.concat(F.lit(" "), F.col("l_extendedprice").cast("string"), F.lit(" "))))
    t = li.select("l_orderkey", "l_linenumber", qty_raw.alias("qty_raw"), price_raw.alias("price_raw"),
                  F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("ship_raw"))
    return t.select("l_orderkey", "l_linenumber", to_type("qty_raw", "int").alias("qty"),
                    to_type(F.trim("price_raw"), "double").alias("price"),
                    to_type("ship_raw", "timestamp").alias("shipped_at"),
                    F.col("l_linenumber").cast("long").alias("line_long"))


@query("typed_flags", sql="""
    select doc_id, cast(quality as boolean) as quality_flag, cast(toxic as boolean) as is_toxic
    from labels""")
def q_typed_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Integer flags -> boolean (the ``is_charging`` cast)."""
    lb = load_table(spark, sf, "labels")
    return lb.select("doc_id", F.col("quality").cast("boolean").alias("quality_flag"),
                     F.col("toxic").cast("boolean").alias("is_toxic"))


@query("epoch_to_ts", sql="""
    select event_id, cast(floor(epoch(ts)) as bigint) as epoch_s,
           date_trunc('second', ts) as reported_at
    from events""")
def q_epoch_to_ts(spark: SparkSession, sf: str) -> DataFrame:
    """Epoch seconds -> timestamp (round trip through whole seconds)."""
    ev = load_table(spark, sf, "events")
    e = ev.select("event_id", F.unix_seconds("ts").alias("epoch_s"))
    return e.select("event_id", "epoch_s", epoch_to_ts("epoch_s").alias("reported_at"))


@query("ride_duration", sql="""
    select l_orderkey, l_linenumber,
           round((epoch(l_shipdate) - epoch(o_orderdate)) / 60.0, 2) as ride_duration_minutes
    from lineitem join orders on l_orderkey = o_orderkey""")
def q_ride_duration(spark: SparkSession, sf: str) -> DataFrame:
    """Minutes between order date (start) and ship date (end), 2 dp, negatives kept."""
    li = load_table(spark, sf, "lineitem")
    o = load_table(spark, sf, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber",
                    duration_minutes("o_orderdate", "l_shipdate").alias("ride_duration_minutes"))


@query("explode_array", sql="""
    select vec_id, label, unnest(range(len(embedding))) as pos, unnest(embedding) as val
    from embeddings""")
def q_explode_array(spark: SparkSession, sf: str) -> DataFrame:
    """One row per array element (rows with a NULL/empty array disappear)."""
    e = load_table(spark, sf, "embeddings")
    return e.select("vec_id", "label", F.posexplode("embedding").alias("pos", "val")) \
        .withColumn("pos", F.col("pos").cast("long"))


@query("rescue_unknown_fields", sql="""
    select event_id, '{"k":"' || json_extract_string(props, '$.k') || '"}' as _rescued_data,
           cast(null as bigint) as known_id
    from events""")
def q_rescue_unknown_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Parse ``props`` with a contract that lacks ``k``; ``k`` lands in ``_rescued_data``."""
    ev = load_table(spark, sf, "events")
    contract = StructType([StructField("id", LongType())])
    r = with_rescued(ev, "props", contract)
    return r.select("event_id", "_rescued_data", F.col("_parsed.id").alias("known_id"))
