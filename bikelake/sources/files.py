"""File sources: incremental JSON / CSV streams, lineage, dimensions, feed lookup
(S1-S3, S6, S8-S10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bikelake.functions.clean import normalize_id
from bikelake.operators.joins import assert_unique


def with_source_file(df: DataFrame, out: str = "_source_file") -> DataFrame:
    """Source-file lineage from the hidden ``_metadata.file_path`` column."""
    return df.withColumn(out, F.col("_metadata.file_path"))


def read_json_stream(spark: SparkSession, path: str, schema: StructType,
                     multi_line: bool = True, max_files: int | None = None) -> DataFrame:
    """Incremental JSON file stream (S1): only files not yet in the checkpoint's log.

    ``multi_line=True`` reads one (pretty-printed) document per file, as the live
    feeds are landed; JSON-lines input is splittable and preferred for bulk.
    """
    r = spark.readStream.schema(schema).option("multiLine", multi_line)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


def read_csv_stream(spark: SparkSession, path: str, schema: StructType,
                    max_files: int | None = None) -> DataFrame:
    """Incremental header-CSV stream (S2); hive directories such as
    ``year=/month=`` become columns when the schema names them (S3)."""
    # Columns are assigned by position: a header in another order must stop the stream, not swap values.
    r = (spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
         .option("basePath", path))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.csv(path)


def table_stream(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table read as a stream of newly appended files."""
    return spark.readStream.table(name)


def load_dim(spark: SparkSession, path: str, schema: StructType | str,
             key: str = "station_id", normalize: bool = True) -> DataFrame:
    """Seed / dimension CSV with an explicit (string) schema, columns taken by header name.

    Keys are read as strings and, by default, normalised like the fact ids, so
    ``x.10`` in the seed still meets ``x.1`` in the trips (trap T20).  A key that
    occurs twice would fan out the lookup join, so it is rejected.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    found = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    dim = found.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])
    if normalize:
        dim = dim.withColumn(key, normalize_id(key))
    assert_unique(dim, [key], what=f"dimension key {key}")
    return dim


def feed_url(discovery: DataFrame, name: str, feeds_path: str = "data.en.feeds") -> DataFrame:
    """URL of the feed called ``name`` in each discovery document."""
    keep = [c for c in discovery.columns if c != "data"]
    return (discovery.select(*keep, F.explode(feeds_path).alias("_feed"))
            .filter(F.col("_feed.name") == name)
            .select(*keep, F.col("_feed.url").alias("url")))
