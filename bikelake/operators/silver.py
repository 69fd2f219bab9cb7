"""Silver transforms: trip cleaning (ST3) and the station current-state build.

``clean_trips`` is a pure row-level transform, used unchanged on a batch
DataFrame and on a streaming one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bikelake.functions.clean import (clean_name, duration_minutes, epoch_to_ts,
                                      normalize_category, normalize_id, to_type)
from bikelake.operators.joins import current_state
from bikelake.operators.latest import latest_per_key

INFO_ORDER = ["last_updated", "_source_file"]
STATUS_ORDER = ["last_reported", "last_updated", "_source_file"]
STATUS_MEASURES = [
    "num_bikes_available", "num_bikes_disabled", "num_docks_available", "num_docks_disabled",
    "num_ebikes_available", "num_scooters_available", "num_scooters_unavailable",
]
STATUS_FLAGS = ["is_installed", "is_renting", "is_returning"]


def flag_to_int(c) -> Column:
    """0/1 from a flag delivered as boolean, number or string (trap T4)."""
    s = F.lower(F.trim((F.col(c) if isinstance(c, str) else c).cast("string")))
    return (F.when(s.isin("true", "1"), 1).when(s.isin("false", "0"), 0)
            .otherwise(s.try_cast("int")))


def clean_trips(df: DataFrame, strict: bool = False) -> DataFrame:
    """Type and standardise raw trip rows; adds ``ride_duration_minutes`` and
    ``_silver_processed_at``.  Rows are not deduplicated (trap T8)."""
    out = df.withColumns({
        "ride_id": F.trim("ride_id"),
        "start_station_id": normalize_id("start_station_id"),
        "end_station_id": normalize_id("end_station_id"),
        "rideable_type": normalize_category("rideable_type"),
        "member_casual": normalize_category("member_casual"),
        "started_at": to_type("started_at", "timestamp", strict),
        "ended_at": to_type("ended_at", "timestamp", strict),
    })
    out = out.withColumns({
        "ride_duration_minutes": duration_minutes("started_at", "ended_at"),
        "start_station_name": clean_name("start_station_name", collapse_ws=True),
        "end_station_name": clean_name("end_station_name", collapse_ws=True),
        "start_lat": to_type("start_lat", "double", strict),
        "start_lng": to_type("start_lng", "double", strict),
        "end_lat": to_type("end_lat", "double", strict),
        "end_lng": to_type("end_lng", "double", strict),
    })
    if "year" in out.columns:
        out = out.withColumns({"year": to_type("year", "int", strict),
                               "month": to_type("month", "int", strict)})
    return out.withColumn("_silver_processed_at", F.current_timestamp())


def latest_information(info: DataFrame, method: str = "window") -> DataFrame:
    """Newest information record per station, cleaned and renamed."""
    df = info.select(
        "station_id",
        clean_name("name", collapse_ws=False).alias("address"),
        F.round(F.col("lat").cast("double"), 6).alias("lat"),
        F.round(F.col("lon").cast("double"), 6).alias("lon"),
        "capacity", "region_id",
        F.col("is_charging").cast("boolean").alias("is_charging"),
        "last_updated", "_source_file",
    )
    latest = latest_per_key(df, ["station_id"], INFO_ORDER, method=method)
    return (latest.withColumn("information_last_updated_at", epoch_to_ts("last_updated"))
            .drop("last_updated")
            .withColumnsRenamed({"_source_file": "information_source_file"}))


def latest_status(status: DataFrame, method: str = "window") -> DataFrame:
    """Newest status record per station (W2, X6, P4, P5); flags as int."""
    df = status.select(
        "station_id", *STATUS_MEASURES,
        *[flag_to_int(f).alias(f) for f in STATUS_FLAGS],
        "last_reported", "last_updated", "_source_file",
    )
    latest = latest_per_key(df, ["station_id"], STATUS_ORDER, method=method)
    return (latest.withColumns({"last_reported_at": epoch_to_ts("last_reported"),
                                "status_last_updated_at": epoch_to_ts("last_updated")})
            .drop("last_reported", "last_updated")
            .withColumnsRenamed({"_source_file": "status_source_file"}))


def silver_stations(info: DataFrame, status: DataFrame, method: str = "window") -> DataFrame:
    """Current state of every station: latest information LEFT JOIN latest status."""
    return (current_state(latest_information(info, method), latest_status(status, method))
            .withColumn("_silver_updated_at", F.current_timestamp()))
