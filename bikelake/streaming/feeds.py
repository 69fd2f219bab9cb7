"""Ingest that loses nothing and follows its input's schema.

A stream of file names (names only: file contents are read by the batch) hands every
micro-batch's files to a function, which writes folders of that batch id.  A batch that runs
again after a stop replaces its own folders, so each file lands once in each of them:

* ``ingest_feed`` (JSON snapshots): rows of ``data.stations`` to bronze under the feed's
  contract; documents that are no JSON object, envelope and ``data`` entries outside their
  contract, and elements that are no objects to quarantine;
* ``ingest_csv`` (header CSV): files are read by their own header, united by column name,
  unknown columns and malformed lines kept in ``_rescued_data``.

Contracts have versions.  A micro-batch whose elements bring new keys widens the contract
before it is parsed; its rows lie under ``contract=<version>``, and ``bronze_view`` unites all
versions, with NULL where an older one lacks a column.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, LongType, StringType, StructField,
                               StructType)

from bikelake.sources.schemas import contract_versions, remember_contract, with_rescued
from bikelake.streaming.ingest import run, with_audit

FILES_PER_BATCH = 1000     # file names handled by the driver at a time
NEW_COLUMNS = 100          # keys that one batch may add as columns; others stay in _rescued_data
HEADER_BYTES = 1 << 16
STAGE_GROUP_BYTES = 8 << 20    # row groups of the parsed pieces of a batch
_BLANKS = " \t\r\n"
_FILE = "path string, modificationTime timestamp, length long, content binary"
_ENVELOPE = StructType([StructField("last_updated", LongType()), StructField("ttl", LongType()),
                        StructField("version", StringType()), StructField("data", StringType())])
_DATA = StructType([StructField("stations", StringType())])
_OWN = ["_rescued_data", "last_updated", "ttl", "_source_file", "_ingested_at", "batch", "contract"]


def file_batches(spark: SparkSession, source: str, checkpoint: str, apply: Callable[[list[str], int], None],
                 max_files: int | None = None) -> None:
    """Call ``apply(paths, batch_id)`` for every micro-batch of files not yet handled."""
    stream = (spark.readStream.format("binaryFile").schema(_FILE)
              .option("maxFilesPerTrigger", max_files or FILES_PER_BATCH).load(source).select("path"))

    def each(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r.path for r in batch.collect())
        if paths:
            apply(paths, batch_id)

    run(stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batches that lie under a landing path of this module."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*/batch=*")
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.globStatus(root) or [])


# ---------------------------------------------------------------- JSON snapshots

def _is_object(text: Column) -> Column:
    return F.coalesce(text.startswith("{") | F.ltrim(text, F.lit(_BLANKS)).startswith("{"), F.lit(False))


def parse_documents(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Adds to each document its envelope fields, ``_elements`` (JSON texts of the objects in
    ``data.stations``) and ``_problems`` (``reason, content`` of all that is not among these).

    A document counts as whole only if its text is one JSON object from end to end: a truncated
    one, or one with more behind it, is a problem as it is and gives no rows.
    """
    text = F.col(text_col)
    one = F.size(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")) == 1
    df = docs.withColumn("_whole", F.coalesce(one & _is_object(text), F.lit(False)))
    df = df.withColumn("_text", F.when(F.col("_whole"), text))
    df = with_rescued(df, "_text", _ENVELOPE, out="_more", parsed="_envelope")
    df = df.withColumn("_data", F.col("_envelope.data"))
    df = with_rescued(df, "_data", _DATA, out="_data_more", parsed="_inner")
    df = df.withColumn("_stations", F.col("_inner.stations"))
    df = df.withColumn("_all", F.from_json("_stations", "array<string>"))

    def problem(when: Column, reason: str, content: Column) -> Column:
        return F.when(when, F.struct(F.lit(reason).alias("reason"), content.alias("content")))

    data, stations = F.col("_data"), F.col("_stations")
    single = F.array(
        problem(~F.col("_whole") & (F.trim(F.coalesce(text, F.lit("")), F.lit(_BLANKS)) != ""), "document", text),
        problem(F.col("_more").isNotNull(), "envelope", F.col("_more")),
        problem(data.isNotNull() & ~_is_object(data), "data", data),
        problem(F.col("_data_more").isNotNull(), "data", F.col("_data_more")),
        problem(stations.isNotNull() & F.col("_all").isNull(), "stations", stations))
    elements = F.transform(F.filter("_all", lambda e: ~_is_object(e)),
                           lambda e: F.struct(F.lit("element").alias("reason"), F.coalesce(e, F.lit("null")).alias("content")))
    return df.select(
        *docs.columns, F.col("_envelope.last_updated").alias("last_updated"), F.col("_envelope.ttl").alias("ttl"),
        F.filter("_all", _is_object).alias("_elements"),
        F.concat(F.filter(single, lambda p: p.isNotNull()), F.coalesce(elements, F.array())).alias("_problems"))


def new_keys(elements: DataFrame, contract: StructType, column: str = "_element",
             limit: int = NEW_COLUMNS) -> StructType:
    """Keys of JSON objects that ``contract`` lacks, with the type that all their values have
    (mixed types and nested values: string; only nulls: not yet a column).  Grouped by key, so
    the driver gets one row per key, at most ``limit`` by name."""
    known = [f.name.lower() for f in contract.fields] + _OWN
    # Keys alone are read first: elements without another key are not parsed (known is in lower
    # case, so a key that differs in case only is looked at again).
    names = F.json_object_keys(column)
    others = F.array_except(names, F.array(*map(F.lit, known)))
    odd = elements.filter(names.isNull() | (F.size(others) > 0))
    found = [r[0] for r in odd.select(F.explode_outer(others).alias("key")).distinct().limit(limit + 1).collect()]
    if len(found) <= limit and all(k is not None and re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", k) for k in found):
        new = sorted(k for k in found if k.lower() not in known)
        row = odd.select(F.try_parse_json(column).alias("all")).agg(*[
            F.schema_of_variant_agg(F.try_variant_get("all", f"$.{k}", "variant")).alias(k) for k in new]).first() if new else ()
        kinds = [(k, name) for k, name in zip(new, row) if name != "VOID"]
    else:                                             # any number of keys, of any form
        kinds = (odd.select(F.explode(F.try_parse_json(column).try_cast("map<string,variant>")).alias("key", "value"))
                 .filter(~F.lower("key").isin(known) & (F.trim("key") != ""))
                 .groupBy("key").agg(F.schema_of_variant_agg("value").alias("kind"))
                 .filter("kind <> 'VOID'").orderBy("key").limit(limit).collect())

    def kind(name: str):
        if name == "BIGINT":
            return LongType()
        if name == "BOOLEAN":
            return BooleanType()
        return DoubleType() if name == "DOUBLE" or name.startswith("DECIMAL") else StringType()

    return StructType([StructField(key, kind(name)) for key, name in kinds])


def pieces(parsed: DataFrame) -> DataFrame:
    """One row per element (``reason`` is NULL) and per problem of parsed documents."""
    none = F.array().cast("array<struct<reason:string,content:string>>")
    elements = F.transform("_elements", lambda e: F.struct(F.lit(None).cast("string").alias("reason"), e.alias("content")))
    # outer: Spark would test the size of an inner one's array first, and parse the document for it once more
    return (parsed.select(F.inline_outer(F.concat(F.coalesce(elements, none), F.coalesce("_problems", none))).alias("reason", "content"),
                          "last_updated", "ttl", "_source_file").filter(F.col("content").isNotNull()))


@contextmanager
def staged(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """``df`` written to a folder of its own, which goes at the end: what several jobs read is made
    once and holds no memory of the executors, as cached rows would.  A run that stops leaves the
    folder to the next one, which replaces it.  Small row groups bound what a task holds
    of long texts, written or read."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("parquet.block.size", STAGE_GROUP_BYTES).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def ingest_feed(spark: SparkSession, source: str, element: StructType, store: str, path: str, quarantine: str,
                checkpoint: str, multi_line: bool = True, max_files: int | None = None, evolve: bool = True) -> None:
    """Snapshot feed to bronze rows and quarantine rows; each input byte is in one of them.

    ``element`` is the contract at least; with ``evolve`` new keys become columns of the batch
    that brings them.  Bronze: ``<path>/contract=<v>/batch=<id>``, quarantine
    (``reason, content, _source_file, _ingested_at``): ``<quarantine>/batch=<id>``.
    """
    remember_contract(spark, store, element)

    def apply(paths: list[str], batch_id: int) -> None:
        docs = (spark.read.text(paths, wholetext=multi_line)
                .select("value", F.col("_metadata.file_path").alias("_source_file")))
        with staged(pieces(parse_documents(docs)), f"{path}/_staged/{batch_id:09d}") as parsed:
            rows = parsed.filter(F.col("reason").isNull()).select(
                F.col("content").alias("_element"), "last_updated", "ttl", "_source_file")
            version, contract = max(contract_versions(spark, store).items())
            if evolve:
                found = new_keys(rows, contract)
                if found.fields:
                    version, contract = remember_contract(spark, store, found)
            bronze = with_rescued(rows, "_element", contract).select(
                "_parsed.*", "_rescued_data", "last_updated", "ttl", "_source_file")
            with_audit(bronze).write.mode("overwrite").parquet(f"{path}/contract={version:06d}/batch={batch_id:09d}")
            bad = parsed.filter(F.col("reason").isNotNull()).select("reason", "content", "_source_file")
            with_audit(bad).write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id:09d}")

    file_batches(spark, source, checkpoint, apply, max_files)


def bronze_view(spark: SparkSession, name: str, store: str, path: str) -> str:
    """``name`` as the union of all contract versions under ``path``: columns and types of the
    newest, NULL where a version lacks a column, ``batch`` for pruning."""
    versions = contract_versions(spark, store)
    newest = versions[max(versions)]
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    there = {int(s.getPath().getName().split("=")[1]) for s in (fs.listStatus(root) if fs.exists(root) else [])
             if s.getPath().getName().startswith("contract=")}

    def quoted(column: str) -> str:
        return "`" + column.replace("`", "``") + "`"

    parts = []
    for v in sorted(there):
        held = {f.name for f in versions[v].fields}
        columns = [f"CAST({quoted(f.name) if f.name in held else 'NULL'} AS {f.dataType.simpleString()}) AS {quoted(f.name)}"
                   for f in newest.fields]
        parts.append(f"SELECT {', '.join([*columns, *_OWN[:-1]])} FROM parquet.`{path}/contract={v:06d}`")
    if not parts:
        types = ["string", "bigint", "bigint", "string", "timestamp", "int"]
        columns = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in newest.fields]
        columns += [f"CAST(NULL AS {t}) AS {c}" for c, t in zip(_OWN, types)]
        parts = [f"SELECT {', '.join(columns)} WHERE false"]
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {' UNION ALL '.join(parts)}")
    return name


# ---------------------------------------------------------------- header CSV

def read_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one CSV file: its first line, read alone; () for an empty file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    size = min(fs.getFileStatus(p).getLen(), HEADER_BYTES)
    file = fs.open(p)
    try:
        data = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(file, size)) if size else b""
    finally:
        file.close()
    first = data.decode("utf-8-sig", "replace").splitlines()[:1]
    if first and size == HEADER_BYTES and len(first[0].encode()) >= HEADER_BYTES - 4:
        raise ValueError(f"the header of {path} is longer than {HEADER_BYTES} bytes")
    return tuple(next(csv.reader(io.StringIO(first[0])), ())) if first else ()


def rows_by_header(spark: SparkSession, header: Sequence[str], paths: list[str], columns: Sequence[str],
                   partitions: Sequence[StructField], base: str, **options) -> DataFrame:
    """Rows of files that share one header, by column name: ``columns`` as strings (NULL where
    the header lacks one), partition columns, ``_rescued_data`` (a JSON object of the other columns'
    values, and of a line that does not fit the header), ``_source_file``."""
    names = [f"_c{k}" for k in range(len(header))]
    schema = StructType([StructField(n, StringType()) for n in [*names, "_corrupt_record"]] + list(partitions))
    raw = (spark.read.schema(schema).options(**{"header": "true", "enforceSchema": "true", **options})
           .option("basePath", base).csv(paths))
    place, other = {}, []
    for n, title in zip(names, (h.strip() for h in header)):
        if title in columns and title not in place:
            place[title] = n
        else:
            other.append((title, n))
    other.append(("_corrupt_record", "_corrupt_record"))
    entries = F.array(*[F.when(F.col(n).isNotNull(), F.struct(F.lit(t).alias("key"), F.col(n).alias("value")))
                        for t, n in other])
    # as text: a map would refuse a title that the header repeats
    pairs = F.transform(F.filter(entries, lambda e: e.isNotNull()),
                        lambda e: F.regexp_replace(F.to_json(F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))), r"^\{|\}$", ""))
    some = F.coalesce(*[F.col(n) for _, n in other]).isNotNull()     # most rows: nothing to put together
    rescued = F.when(some, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")))
    return raw.select(
        *[F.col(place[c]).alias(c) if c in place else F.lit(None).cast("string").alias(c) for c in columns],
        *[f.name for f in partitions], rescued.alias("_rescued_data"), F.col("_metadata.file_path").alias("_source_file"))


def ingest_csv(spark: SparkSession, source: str, columns: Sequence[str], partitions: Sequence[StructField], path: str,
               checkpoint: str, max_files: int | None = None, **options) -> None:
    """Header CSV files under hive folders to ``<path>/rows/batch=<id>``.

    Every file's header is read first; the files of a batch are read once per distinct header
    and united by name, so columns may come in any order, some may miss and others may be new.
    """
    def apply(paths: list[str], batch_id: int) -> None:
        by_header: dict[tuple[str, ...], list[str]] = {}
        for p in paths:
            by_header.setdefault(read_header(spark, p), []).append(p)
        by_header.pop((), None)
        parts = [rows_by_header(spark, h, ps, columns, partitions, source, **options)
                 for h, ps in sorted(by_header.items())]
        if parts:
            rows = parts[0]
            for more in parts[1:]:
                rows = rows.unionByName(more)
            with_audit(rows).write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id:09d}")

    file_batches(spark, source, checkpoint, apply, max_files)


def csv_table(spark: SparkSession, name: str, columns: Sequence[str], partitions: Sequence[StructField], path: str) -> str:
    """``name`` as a table over what ``ingest_csv`` lands, for batch reads and as a stream (S8);
    batches are plain folders to it."""
    fields = [*[f"`{c}` string" for c in columns], *[f"{f.name} {f.dataType.simpleString()}" for f in partitions],
              "_rescued_data string", "_source_file string", "_ingested_at timestamp"]
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/rows")
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(folder)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(fields)}) USING parquet "
              f"OPTIONS (recursiveFileLookup 'true', path '{path}/rows')")
    return name
