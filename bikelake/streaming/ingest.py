"""Incremental ingestion with Structured Streaming (K1, P1, P2, P6, S6, ST1, ST3, ST4).

Every job is ``readStream`` -> pure transform -> ``writeStream`` in append mode
with ``trigger(availableNow=True)``: it processes the files not yet recorded in
its checkpoint and stops.  The checkpoint (file log + commit log) lives in the
shared folder, so a rerun after a failure — or a lost executor mid-batch —
replays only the uncommitted batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from bikelake.operators.silver import clean_trips
from bikelake.sources.files import (read_csv_stream, read_json_stream, table_stream,
                                    with_source_file)
from bikelake.sources.schemas import raw_envelope, with_rescued

ENVELOPE_COLUMNS = ["last_updated", "ttl"]


def with_audit(df: DataFrame, name: str = "_ingested_at") -> DataFrame:
    """Processing-time audit column (constant within a micro-batch)."""
    return df.withColumn(name, F.current_timestamp())


def explode_snapshot(df: DataFrame, array_path: str = "data.stations",
                     envelope_cols: Sequence[str] = ENVELOPE_COLUMNS,
                     keep: Sequence[str] = ("_source_file",)) -> DataFrame:
    """One row per array element, element fields flattened, envelope fields kept.

    ``explode`` drops documents whose array is NULL or empty.
    """
    carry = [c for c in list(envelope_cols) + list(keep) if c in df.columns]
    return (df.select(F.explode(array_path).alias("_element"), *carry)
            .select("_element.*", *carry))


def bronze_snapshot(raw: DataFrame, element: StructType | None = None) -> DataFrame:
    """Bronze transform of a snapshot feed: lineage, explode, audit.

    With ``element`` the stream was read with raw element strings
    (``raw_envelope``): each element is parsed against the contract and keys that
    are unknown, or whose value does not fit the contracted type, are kept in
    ``_rescued_data`` (schema drift never fails ingestion and loses nothing).
    """
    df = with_source_file(raw)
    if element is None:
        return with_audit(explode_snapshot(df))
    carry = [c for c in ENVELOPE_COLUMNS + ["_source_file"] if c in df.columns]
    rows = df.select(F.explode("data.stations").alias("_element"), *carry)
    parsed = with_rescued(rows, "_element", element).select("_parsed.*", "_rescued_data", *carry)
    return with_audit(parsed)


def bronze_trips(raw: DataFrame) -> DataFrame:
    """Bronze transform of trip CSVs: kept raw, plus lineage and audit."""
    return with_audit(with_source_file(raw))


def append_stream(df: DataFrame, checkpoint: str, path: str | None = None,
                  table: str | None = None, fmt: str = "parquet",
                  merge_schema: bool = False, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Checkpointed append of a streaming DataFrame, run to completion of the
    currently available input (``availableNow``)."""
    w = (df.writeStream.outputMode("append").format(fmt)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if merge_schema:
        w = w.option("mergeSchema", "true")
    if table:
        if path:
            w = w.option("path", path)
        return w.toTable(table)
    return w.start(path)


def run(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def ingest_snapshots(spark: SparkSession, source: str, element: StructType, checkpoint: str,
                     path: str | None = None, table: str | None = None,
                     multi_line: bool = True, max_files: int | None = None,
                     wait: bool = True) -> StreamingQuery:
    """Bronze job for a JSON snapshot feed (station information / status).

    ``element`` is the contract of one ``data.stations`` element; unknown or
    mistyped element fields land in ``_rescued_data``.
    """
    raw = read_json_stream(spark, source, raw_envelope(), multi_line=multi_line, max_files=max_files)
    q = append_stream(bronze_snapshot(raw, element), checkpoint, path=path, table=table)
    return run(q) if wait else q


def ingest_trips(spark: SparkSession, source: str, schema: StructType, checkpoint: str,
                 path: str | None = None, table: str | None = None,
                 max_files: int | None = None) -> StreamingQuery:
    """Bronze job for monthly trip CSVs under ``year=/month=`` folders."""
    raw = read_csv_stream(spark, source, schema, max_files=max_files)
    return run(append_stream(bronze_trips(raw), checkpoint, path=path, table=table))


def clean_trips_stream(spark: SparkSession, bronze_table: str, checkpoint: str,
                       path: str | None = None, table: str | None = None,
                       partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Silver job: bronze trips table -> ``clean_trips`` -> append (ST3).

    ``partition_by=("year", "month")`` lays the table out by the trip files'
    month, so readers that filter on it prune whole folders."""
    return run(append_stream(clean_trips(table_stream(spark, bronze_table)), checkpoint,
                             path=path, table=table, partition_by=partition_by))
