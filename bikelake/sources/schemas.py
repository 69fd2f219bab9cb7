"""Schema contracts for the feeds and the rescued-data column.

A streaming source's schema is fixed when the query starts, so every feed has
an explicit contract.  Keys that are not in the contract — and known keys whose
value does not parse as the contracted type — are preserved in ``_rescued_data``
(a JSON object of strings) instead of failing ingestion.
"""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DataType, DoubleType, LongType,
                               StringType, StructField, StructType)

# Fields of one element of data.stations in the station-information feed.
STATION_INFORMATION = StructType([
    StructField("station_id", StringType()),
    StructField("name", StringType()),
    StructField("lat", DoubleType()),
    StructField("lon", DoubleType()),
    StructField("capacity", LongType()),
    StructField("region_id", StringType()),
    StructField("is_charging", BooleanType()),
])

# Fields of one element of data.stations in the station-status feed.  Flags are
# read as strings so that both true/false and 0/1 feeds load; Silver casts them
# to int (trap T4).
STATION_STATUS = StructType([
    StructField("station_id", StringType()),
    StructField("num_bikes_available", LongType()),
    StructField("num_bikes_disabled", LongType()),
    StructField("num_docks_available", LongType()),
    StructField("num_docks_disabled", LongType()),
    StructField("num_ebikes_available", LongType()),
    StructField("num_scooters_available", LongType()),
    StructField("num_scooters_unavailable", LongType()),
    StructField("is_installed", StringType()),
    StructField("is_renting", StringType()),
    StructField("is_returning", StringType()),
    StructField("last_reported", LongType()),
])

# Trip CSV header; every column is read as a string and typed in Silver.
TRIP_COLUMNS = [
    "ride_id", "rideable_type", "started_at", "ended_at", "start_station_name",
    "start_station_id", "end_station_name", "end_station_id", "start_lat", "start_lng",
    "end_lat", "end_lng", "member_casual",
]

# Discovery document: data.en.feeds[] = {name, url}.
FEED = StructType([StructField("name", StringType()), StructField("url", StringType())])
DISCOVERY = StructType([
    StructField("last_updated", LongType()),
    StructField("ttl", LongType()),
    StructField("data", StructType([
        StructField("en", StructType([StructField("feeds", ArrayType(FEED))])),
    ])),
])


def envelope(element, extra: StructType | None = None) -> StructType:
    """Snapshot document: ``last_updated, ttl, version, data.stations[]``."""
    fields = [
        StructField("last_updated", LongType()),
        StructField("ttl", LongType()),
        StructField("version", StringType()),
        StructField("data", StructType([StructField("stations", ArrayType(element))])),
    ]
    return StructType(fields + (list(extra.fields) if extra else []))


def raw_envelope() -> StructType:
    """Snapshot document with every ``data.stations`` element kept as its raw JSON text,
    so elements can be parsed against the contract *and* keep what does not fit."""
    return envelope(StringType())


def all_strings(columns, partitions: dict[str, DataType] | None = None) -> StructType:
    """All-string schema for a header CSV plus typed partition columns."""
    fields = [StructField(c, StringType()) for c in columns]
    for name, dt in (partitions or {}).items():
        fields.append(StructField(name, dt))
    return StructType(fields)


def infer_schema(spark: SparkSession, sample_path: str, store_path: str,
                 fmt: str = "json", **options) -> StructType:
    """Infer a typed schema from sample files once and remember it.

    The schema is stored as JSON text under ``store_path`` (a shared folder) and
    reused by later runs, so a stream keeps a stable contract.
    """
    try:
        stored = spark.read.text(store_path).collect()
        if stored and stored[0][0].strip():
            return StructType.fromJson(json.loads(stored[0][0]))
        raise ValueError(f"schema store {store_path} is empty")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # only a missing store is inferred anew
            raise
    schema = spark.read.options(**options).format(fmt).load(sample_path).schema
    (spark.createDataFrame([(schema.json(),)], "schema string")
     .coalesce(1).write.mode("overwrite").text(store_path))
    return schema


def merge_types(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds both: long widens to double, all else to string (the
    value's JSON text)."""
    if a == b:
        return a
    if {type(a), type(b)} == {LongType, DoubleType}:
        return DoubleType()
    return StringType()


def merge_contracts(old: StructType, new: StructType) -> StructType:
    """Fields of ``old`` in their order, types widened where ``new`` needs it, then the new
    fields.  Names that differ in case only are one column to Spark: the first one stays."""
    found = {f.name: f.dataType for f in new.fields}
    fields = [StructField(f.name, merge_types(f.dataType, found[f.name]) if f.name in found else f.dataType)
              for f in old.fields]
    held = {f.name.lower() for f in fields}
    for f in new.fields:
        if f.name.lower() not in held:
            held.add(f.name.lower())
            fields.append(StructField(f.name, f.dataType))
    return StructType(fields)


def contract_versions(spark: SparkSession, store: str) -> dict[int, StructType]:
    """All versions of a contract: one folder ``v<NNNNNN>`` each, never written again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = {}
    for status in fs.listStatus(path) if fs.exists(path) else []:
        name = status.getPath().getName()
        if re.fullmatch(r"v\d{6}", name):
            rows = spark.read.text(f"{store}/{name}").collect()
            if rows:                                  # else: a stop while the version was written
                found[int(name[1:])] = StructType.fromJson(json.loads(rows[0][0]))
    return found


def remember_contract(spark: SparkSession, store: str, contract: StructType) -> tuple[int, StructType]:
    """Merge ``contract`` into the newest remembered version; a wider one becomes the next."""
    versions = contract_versions(spark, store)
    last = max(versions, default=0)
    merged = merge_contracts(versions[last], contract) if last else contract
    if last and merged == versions[last]:
        return last, merged
    (spark.createDataFrame([(merged.json(),)], "contract string").coalesce(1)
     .write.mode("overwrite").text(f"{store}/v{last + 1:06d}"))
    return last + 1, merged


def remembered_schema(spark: SparkSession, sample_path: str, store: str, fmt: str = "json",
                      **options) -> tuple[int, StructType]:
    """Version and schema: what sample files show now merged with what earlier runs knew.

    A field that the sample lacks stays, one that it shows wider (long, then double, then
    string) widens, a new one is added at the end; a sample that shows nothing wider makes
    no new version.
    """
    return remember_contract(spark, store, spark.read.options(**options).format(fmt).load(sample_path).schema)


def with_rescued(df: DataFrame, json_col: str, schema: StructType,
                 out: str = "_rescued_data", parsed: str = "_parsed") -> DataFrame:
    """Parse ``json_col`` with ``schema`` into ``parsed`` and keep what does not fit.

    ``out`` is a JSON object (values as strings) of every top-level key that is
    not in the schema, plus every known key whose value failed to parse
    (typed NULL, raw value present); NULL when nothing was rescued.
    """
    # Parse once into columns; the rescue below reads these columns many times
    # (Spark does not share a parse across conditional branches / lambdas, and
    # does not inline a non-cheap expression into several consumers).
    known = [f.name for f in schema.fields]
    df = df.withColumns({parsed: F.from_json(F.col(json_col), schema), "_keys": F.json_object_keys(json_col)})
    typed, keys = F.col(parsed), F.col("_keys")
    if known:
        # As many keys as columns with a value, and none unknown: nothing to rescue, so the
        # second parse and its maps are left out (NULL keys or repeated ones take the long way).
        held = sum((F.when(typed[n].isNotNull(), 1).otherwise(0) for n in known), F.lit(0))
        fits = (F.size(keys) > 0) & (F.size(keys) == held) & (F.size(F.array_except(keys, F.array(*map(F.lit, known)))) == 0)
        df = df.withColumn("_fits", F.coalesce(fits, F.lit(False)))
    else:
        df = df.withColumn("_fits", F.lit(False))
    df = df.withColumn("_raw_map", F.when(~F.col("_fits"), F.from_json(F.col(json_col), "map<string,string>")))
    raw = F.col("_raw_map")
    unknown = F.map_filter(raw, lambda k, v: ~k.isin(known)) if known else raw
    if known:
        bad_entries = [F.struct(F.lit(n).alias("key"), raw[n].alias("value")) for n in known]
        bad_arr = F.filter(
            F.array(*[F.when(typed[n].isNull() & raw[n].isNotNull(), e)
                      for n, e in zip(known, bad_entries)]),
            lambda e: e.isNotNull())
        bad = F.map_from_entries(bad_arr)
        # Joined as text: a map function would reject a key that the feed repeats.
        more, rest = F.to_json(unknown), F.to_json(bad)
        rescued = (F.when(F.size(bad) <= 0, F.when(F.size(unknown) > 0, more))
                   .when(F.size(unknown) <= 0, rest)
                   .otherwise(F.concat(F.regexp_replace(more, r"\}$", ","), F.regexp_replace(rest, r"^\{", ""))))
    else:
        rescued = F.when(F.size(unknown) > 0, F.to_json(unknown))
    return df.withColumn(out, F.when(~F.col("_fits"), rescued)).drop("_raw_map", "_keys", "_fits")
