"""Date-partitioned raw landing (K5).

Snapshots land under ``year=YYYY/month=MM/day=DD[/hour=HH]/`` derived from a
UTC timestamp column; reading the folder back yields the partition columns.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

# Microsecond timestamps in JSON (the default writer keeps milliseconds only).
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

GRAINS = {"month": ["year", "month"], "day": ["year", "month", "day"],
          "hour": ["year", "month", "day", "hour"]}


def partition_columns(ts_col: str, grain: str = "day") -> dict:
    t = F.col(ts_col)
    parts = {"year": F.date_format(t, "yyyy"), "month": F.date_format(t, "MM"),
             "day": F.date_format(t, "dd"), "hour": F.date_format(t, "HH")}
    return {k: parts[k] for k in GRAINS[grain]}


def land_snapshots(df: DataFrame, path: str, ts_col: str, grain: str = "day",
                   fmt: str = "json", drop_ts: bool = False, snapshot: str | None = None, **options) -> None:
    """Land ``df`` under hive-style date folders (zero-padded, UTC).

    Without ``snapshot`` rows are appended.  With it (the feed's name for this delivery) files
    are named after it and a manifest lists them, so a run that is tried again replaces what it
    landed before, whatever it got done.
    """
    if snapshot is not None and not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._=-]*", snapshot):
        raise ValueError(f"{snapshot!r} cannot be part of a file name")
    cols = partition_columns(ts_col, grain)
    out = df.withColumns(cols)
    if drop_ts:
        out = out.drop(ts_col)
    # REBALANCE groups rows of a date folder into few files, and AQE splits a
    # folder that is skewed (one hot day) over several tasks instead of one.
    out = out.hint("rebalance", *cols)
    target = path if snapshot is None else f"{path}/_landing/{snapshot}-{uuid.uuid4().hex[:12]}"
    (out.write.mode("append").partitionBy(*cols).format(fmt)
     .option("timestampFormat", JSON_TS_FORMAT).options(**options).save(target))
    if snapshot is not None:
        _take_in(df.sparkSession, path, target, snapshot)


def _take_in(spark: SparkSession, path: str, staged: str, snapshot: str) -> None:
    """Move staged files to names made of ``snapshot`` and a number; the manifest names every file
    that may lie there before the first one moves, and only the landed ones after the last."""
    jvm = spark._jvm.org.apache.hadoop.fs
    root = jvm.Path(staged)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    prefix, moves, place = fs.makeQualified(root).toString() + "/", {}, {}
    found = fs.listFiles(root, True)
    while found.hasNext():
        name = found.next().getPath().toString().removeprefix(prefix)
        folder, _, file = name.rpartition("/")
        if not file.startswith(("_", ".")):
            moves[name] = folder, file
    for name, (folder, file) in sorted(moves.items()):
        place[folder] = place.get(folder, -1) + 1
        moves[name] = f"{folder}/{snapshot}-{place[folder]:05d}.{file.partition('.')[2]}"
    manifest = f"{path}/_manifest/{snapshot}"
    there = fs.exists(jvm.Path(manifest))
    old = {r.value for r in spark.read.text(manifest).collect()} if there else set()
    new = set(moves.values())

    def note(names: set[str], mode: str) -> None:
        (spark.createDataFrame([(n,) for n in sorted(names)], "value string").coalesce(1)
         .write.mode(mode).text(manifest))

    note(new, "append")                      # a stop from here on leaves a manifest of old and new
    for name, to in moves.items():
        file = jvm.Path(f"{path}/{to}")
        fs.mkdirs(file.getParent())
        fs.delete(file, False)
        if not fs.rename(jvm.Path(f"{staged}/{name}"), file):
            raise OSError(f"{name} could not be moved to {to}")
    for name in old - new:
        fs.delete(jvm.Path(f"{path}/{name}"), False)
    note(new, "overwrite")
    fs.delete(root, True)


def read_landed(spark: SparkSession, path: str, schema: StructType, grain: str = "day",
                fmt: str = "json") -> DataFrame:
    """Batch read of a landing folder with typed partition columns."""
    full = StructType(list(schema.fields) + [StructField(c, IntegerType()) for c in GRAINS[grain]])
    return (spark.read.schema(full).format(fmt).option("timestampFormat", JSON_TS_FORMAT)
            .load(path))
