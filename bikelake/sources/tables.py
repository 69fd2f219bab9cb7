"""Batch table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def with_session_timestamps(df: DataFrame) -> DataFrame:
    """Cast ``timestamp_ntz`` columns to ``timestamp`` (session time zone, UTC).

    ``cast(ntz as bigint)`` is rejected by Spark, while the station/trip
    operators need epoch arithmetic on timestamps (trap T17).  The cast is a
    projection over the scan, so column pruning still reaches parquet.
    """
    ntz = {f.name for f in df.schema.fields if isinstance(f.dataType, TimestampNTZType)}
    if not ntz:
        return df
    return df.select([F.col(c).cast("timestamp").alias(c) if c in ntz else F.col(c)
                      for c in df.columns])


def load_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read ``{base}/{name}.parquet`` (file or folder) with session timestamps."""
    return with_session_timestamps(spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet"))


def table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan."""
    return with_session_timestamps(spark.table(name))
