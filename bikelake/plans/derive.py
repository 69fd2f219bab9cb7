"""Feed-shaped data derived by Spark from the test tables.

The test tables hold no stations or trips.  These functions reshape them —
as distributed Spark jobs whose size grows with the tables — into the raw
inputs of the mobility flows: station-status and station-information snapshot
documents, trip CSV rows and feed-discovery documents.  Each document holds a
bounded number of elements (``DOC_SIZE``), so no group grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOC_SIZE = 256
# Epoch of 2024-01-01T00:00:00Z, base of the information feed's last_updated.
INFO_EPOCH = 1704067200
# Feed names of a discovery document (fixed values of the feed standard).
FEED_NAMES = ["system_information", "station_information", "station_status",
              "system_regions", "vehicle_types"]


def _floor_div(c: Column, n: int) -> Column:
    return F.floor(c / F.lit(n)).cast("long")


def status_element(ev: DataFrame) -> Column:
    c = F.col
    v = F.floor(c("value")).cast("long")
    return F.struct(
        c("user_id").cast("string").alias("station_id"),
        _floor_div(c("value"), 10).alias("num_bikes_available"),
        (v % 3).alias("num_bikes_disabled"),
        (v % 7).alias("num_docks_available"),
        (c("event_id") % 2).alias("num_docks_disabled"),
        _floor_div(c("value"), 20).alias("num_ebikes_available"),
        F.lit(0).cast("long").alias("num_scooters_available"),
        F.lit(0).cast("long").alias("num_scooters_unavailable"),
        (c("event_type") != "error").alias("is_installed"),             # JSON boolean
        F.when(c("event_type") == "signup", 0).otherwise(1).alias("is_renting"),   # JSON 0/1
        F.when(c("event_type").isin("signup", "view"), 0).otherwise(1).alias("is_returning"),
        F.unix_seconds("ts").alias("last_reported"),
        c("event_id").alias("event_id"),
    )


def status_documents(events: DataFrame) -> DataFrame:
    """Status snapshots: events of one day, at most ``DOC_SIZE`` consecutive ids per document."""
    g = events.groupBy(F.to_date("ts").alias("_day"), _floor_div(F.col("event_id"), DOC_SIZE).alias("_blk"))
    docs = g.agg(F.max(F.unix_seconds("ts")).alias("last_updated"),
                 F.collect_list(status_element(events)).alias("stations"))
    return docs.select("_day", "last_updated", F.lit(60).cast("long").alias("ttl"),
                       F.lit("2.3").alias("version"), F.struct("stations").alias("data"))


def faulty_status_texts(events: DataFrame) -> DataFrame:
    """Status snapshots as one JSON text a line (column ``value``) with faults by rule: every
    document has a ``doc`` key outside the contract, each third block's ``ttl`` is no number,
    each fiftieth event is a bare number, each eleventh block's text lacks its end."""
    blk = F.col("_blk")
    bare = F.col("event_id") % 50 == 0
    element = F.when(bare, F.col("event_id").cast("string")).otherwise(F.to_json(status_element(events).dropFields("event_id")))
    g = events.groupBy(F.to_date("ts").alias("_day"), _floor_div(F.col("event_id"), DOC_SIZE).alias("_blk"))
    docs = g.agg(F.max(F.unix_seconds("ts")).alias("last_updated"), F.array_join(F.collect_list(element), ",").alias("list"))
    doc = F.concat(F.col("_day").cast("string"), F.lit("/"), blk.cast("string"))
    text = F.concat(F.lit('{"doc":"'), doc, F.lit('","last_updated":'), F.col("last_updated").cast("string"),
                    F.lit(',"ttl":'), F.when(blk % 3 == 0, '"soon"').otherwise("60"),
                    F.lit(',"version":"2.3","data":{"stations":['), F.col("list"), F.lit("]}}"))
    cut = F.expr("substr(value, 1, length(value) - 2)")
    return docs.select(blk, text.alias("value")).select(F.when(blk % 11 == 5, cut).otherwise(F.col("value")).alias("value"))


def information_documents(customer: DataFrame) -> DataFrame:
    """Information snapshots: customers as stations (names with direction/number pairs)."""
    c = F.col
    direction = F.element_at(F.array(*[F.lit(x) for x in "WENS"]), (c("c_custkey") % 4 + 1).cast("int"))
    name = F.concat(F.lit(" "), direction, F.lit("  "), c("c_nationkey").cast("string"),
                    F.lit(" St & "), c("c_mktsegment"), F.lit(" "))
    el = F.struct(
        c("c_custkey").cast("string").alias("station_id"),
        name.alias("name"),
        (c("c_acctbal") / F.lit(97.0)).alias("lat"),
        (c("c_nationkey") * F.lit(1.5)).alias("lon"),
        (c("c_nationkey") + 5).cast("long").alias("capacity"),
        c("c_nationkey").cast("string").alias("region_id"),
        (c("c_custkey") % 2 == 0).alias("is_charging"),
    )
    g = customer.groupBy(_floor_div(c("c_custkey"), DOC_SIZE).alias("_blk"))
    docs = g.agg(F.max(F.lit(INFO_EPOCH) + c("c_custkey")).alias("last_updated"),
                 F.collect_list(el).alias("stations"))
    return docs.select("_blk", "last_updated", F.lit(3600).cast("long").alias("ttl"),
                       F.lit("2.3").alias("version"), F.struct("stations").alias("data"))


def trip_rows(events: DataFrame) -> DataFrame:
    """Trip-shaped string rows (the CSV header of the trip files) plus ``_ts``.

    Timestamps are written with microseconds (trap T23); ids carry the dirt that
    the cleaning removes (blanks, trailing ``_``, redundant zeros).
    """
    c = F.col
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    ended = F.timestamp_micros(F.unix_micros("ts") + F.floor(c("value") * F.lit(60000000.0)).cast("long"))
    uid = c("user_id").cast("string")
    start_id = F.concat(F.lit(" "), uid, F.lit(".0"), (c("event_id") % 10).cast("string"),
                        F.repeat(F.lit("_"), (c("event_id") % 3).cast("int")))
    end_id = F.concat(((c("user_id") + c("event_id")) % 150).cast("string"), F.lit(".10"))
    return events.select(
        c("ts").alias("_ts"),
        F.concat(F.lit(" R"), c("event_id").cast("string")).alias("ride_id"),
        F.when(c("event_id") % 2 == 0, " Electric_Bike").otherwise("classic_bike ").alias("rideable_type"),
        F.date_format("ts", fmt).alias("started_at"),
        F.date_format(ended, fmt).alias("ended_at"),
        F.concat(F.lit("W  "), uid, F.lit(" St")).alias("start_station_name"),
        start_id.alias("start_station_id"),
        F.concat(F.lit(" E "), (c("user_id") % 50).cast("string"), F.lit("\tAve ")).alias("end_station_name"),
        end_id.alias("end_station_id"),
        F.format_string("%.4f", c("value") / F.lit(10.0)).alias("start_lat"),
        F.when(c("event_type") == "error", "").otherwise(c("user_id").cast("string")).alias("start_lng"),
        F.when(c("event_type") == "view", "n/a").otherwise(F.format_string("%.2f", c("value"))).alias("end_lat"),
        c("event_id").cast("string").alias("end_lng"),
        F.when(c("event_type").isin("click", "view"), " Member").otherwise("casual").alias("member_casual"),
    )


def discovery_documents(supplier: DataFrame) -> DataFrame:
    """Feed-discovery documents: five suppliers per document, one feed name each."""
    c = F.col
    feed = F.struct(
        F.element_at(F.array(*[F.lit(x) for x in FEED_NAMES]), (c("s_suppkey") % 5 + 1).cast("int")).alias("name"),
        F.concat(F.lit("https://feeds.example/"), c("s_name"), F.lit("/"),
                 c("s_nationkey").cast("string"), F.lit(".json")).alias("url"))
    g = supplier.groupBy(_floor_div(c("s_suppkey"), 5).alias("doc_id"))
    return g.agg(F.collect_list(feed).alias("feeds")).select(
        "doc_id", F.lit(INFO_EPOCH).cast("long").alias("last_updated"),
        F.struct(F.struct("feeds").alias("en")).alias("data"))
