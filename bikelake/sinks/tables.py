"""Publishing and keyed upsert over versioned parquet.

Open-source Spark has no MERGE for plain parquet tables, and a table cannot be
overwritten while it is being read.  Every publish writes a complete new version
into a folder of its own, ``<root>/<table>/v<NNNNNN>-<unique>``, and then replaces
the table's definition: a view over that folder.  The one ``CREATE OR REPLACE VIEW``
carries location, version and last streaming batch together, whatever the schema
and partitioning, so a crash before it leaves the old version in place and a crash
after it the new one.  No folder is ever written twice and nothing is dropped;
``prune_versions`` removes old folders.

A keyed table (``upsert``) is cut into buckets by a hash of its keys.  A merge writes only the
buckets that its rows fall in, all under one new version folder, ``<version>/_bucket=<k>``;
the view names the current folder of every bucket, so the switch is again one change of the
catalog.  Bucket folders that the last ``KEPT_VERSIONS`` versions no longer name are deleted
by the merge itself.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from bikelake.operators.latest import _orderable, latest_per_key

VERSION_PROP = "bikelake.version"
BATCH_PROP = "bikelake.batch_id"
PATH_PROP = "bikelake.path"
SCHEMA_PROP = "bikelake.schema"         # columns of a keyed table, so that a merge infers nothing
BUCKETS_PROP = "bikelake.buckets"       # number of buckets of a keyed table
MAP_PROP = "bikelake.map."              # + version: folder of every bucket in that version
FROM_PROP = "bikelake.from."            # + input: last batch of it that the table holds
KEPT_VERSIONS = 3  # versions whose folders stay readable
BUCKETS = 16       # default for new keyed tables: some 100 MB a bucket is a good size


def table_props(spark: SparkSession, name: str) -> dict:
    """What the table's definition says of its version; empty where there is no table."""
    return _props(spark, name)


def _props(spark: SparkSession, name: str) -> dict:
    if not spark.catalog.tableExists(name):
        return {}
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def table_version(spark: SparkSession, name: str) -> int:
    return int(_props(spark, name).get(VERSION_PROP, 0))


def last_batch(spark: SparkSession, name: str) -> int:
    return int(_props(spark, name).get(BATCH_PROP, -1))


def write_version(df: DataFrame, name: str, root: str, partition_by: Sequence[str] = ()) -> tuple[int, str]:
    """Write ``df`` as a version that no reader sees yet; returns its number and folder."""
    v = table_version(df.sparkSession, name) + 1
    path = f"{root.rstrip('/')}/{name.replace('.', '/')}/v{v:06d}-{uuid.uuid4().hex[:12]}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return v, path


def switch(spark: SparkSession, name: str, version: int, path: str, batch_id: int | None = None,
           props: dict | None = None, view_path: str | None = None, old: dict | None = None) -> int:
    """Make a written version the table's content, in one change of the catalog; ``props``
    (what the version was made from) become visible with it."""
    old = _props(spark, name) if old is None else old
    batch = str(batch_id) if batch_id is not None else old.get(BATCH_PROP)
    kept = {k: v for k, v in old.items() if k.startswith(FROM_PROP)}
    new = {**kept, VERSION_PROP: str(version), PATH_PROP: path,
           **({BATCH_PROP: batch} if batch is not None else {}), **(props or {})}
    quoted = str.maketrans({"\\": "\\\\", "'": "\\'"})
    plist = ", ".join(f"'{k}'='{val.translate(quoted)}'" for k, val in new.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({plist}) AS SELECT * FROM parquet.`{view_path or path}`")
    return version


def publish(df: DataFrame, name: str, root: str, batch_id: int | None = None,
            partition_by: Sequence[str] = ()) -> int:
    """Write ``df`` as the next version of table ``name`` and switch the table to it.

    Creates the table on first use (K2); later calls are full rebuilds (K4).
    Returns the new version number.
    """
    v, path = write_version(df, name, root, partition_by)
    return switch(df.sparkSession, name, v, path, batch_id)


def prune_versions(spark: SparkSession, name: str, root: str, keep: int = KEPT_VERSIONS) -> int:
    """Delete version folders older than the newest ``keep`` up to the current one, and never
    the current one; returns how many.  Readers of a version that old must have ended."""
    props = _props(spark, name)
    now, current = int(props.get(VERSION_PROP, 0)), props.get(PATH_PROP, "")
    named = {f for k, m in props.items() if k.startswith(MAP_PROP) for f in _read_map(m).values()}
    jvm = spark._jvm.org.apache.hadoop.fs
    folder = jvm.Path(f"{root.rstrip('/')}/{name.replace('.', '/')}")
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    gone = 0
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        found = re.fullmatch(r"v(\d{6})-[0-9a-f]{12}", status.getPath().getName())
        if found and int(found[1]) <= now - keep and found[0] not in named and not current.endswith(found[0]):
            gone += bool(fs.delete(status.getPath(), True))
    return gone


def _non_null(keys):
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return cond


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 order_desc: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``target`` after a MERGE of ``source`` on ``keys``.

    * matched key  -> source row replaces target row (update all);
    * new key      -> source row inserted (insert all);
    * target keys absent from source stay (MERGE never deletes, trap T13);
    * a NULL key never matches, so a NULL-key source row is inserted (J6).

    With ``order_desc`` a source row replaces a target row only when it is not
    older by those columns, which makes replays of the same batch idempotent.

    Only target rows whose key occurs in ``source`` take part in a shuffle; the
    rest of the target is filtered by an anti join against the source keys, a
    map-only pass where these are small enough for Catalyst to broadcast them.
    """
    keys = list(keys)
    src_keys = source.filter(_non_null(keys)).select(*keys).distinct()
    probe = src_keys
    untouched = target.join(probe, keys, "left_anti")
    if not order_desc:
        return untouched.unionByName(source, allowMissingColumns=True)
    hit = target.join(probe, keys, "left_semi").withColumn("_from_source", F.lit(0))
    src = source.filter(_non_null(keys)).withColumn("_from_source", F.lit(1))
    newest = latest_per_key(hit.unionByName(src, allowMissingColumns=True), keys,
                            list(order_desc) + ["_from_source"]).drop("_from_source")
    null_key_src = source.filter(~_non_null(keys))
    return untouched.unionByName(newest, allowMissingColumns=True) \
        .unionByName(null_key_src, allowMissingColumns=True)


def assert_unique_source(source: DataFrame, keys: Sequence[str]) -> None:
    """A MERGE fails when several source rows match one target row."""
    from bikelake.operators.joins import assert_unique
    assert_unique(source, list(keys), what="source key")


# ---------------------------------------------------------------- bucketed keyed tables

def _bucket(keys: Sequence[str], buckets: int):
    """Bucket of a row; a NULL key hashes like a value, so it has a bucket too."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _write_map(folders: dict[int, str]) -> str:
    """``folder:bucket,bucket;folder:...`` of every bucket that has rows."""
    held: dict[str, list[int]] = {}
    for b, folder in sorted(folders.items()):
        held.setdefault(folder, []).append(b)
    return ";".join(f"{folder}:{','.join(map(str, bs))}" for folder, bs in held.items())


def _read_map(text: str) -> dict[int, str]:
    return {int(b): folder for part in text.split(";") if part
            for folder, bs in [part.split(":")] for b in bs.split(",")}


def _table_root(name: str, root: str) -> str:
    return f"{root.rstrip('/')}/{name.replace('.', '/')}"


def bucket_folders(spark: SparkSession, name: str, root: str, props: dict | None = None) -> dict[int, str]:
    """Current folder of every bucket of a keyed table that has rows."""
    props = _props(spark, name) if props is None else props
    found = _read_map(props.get(MAP_PROP + props.get(VERSION_PROP, ""), ""))
    return {b: f"{_table_root(name, root)}/{folder}/_bucket={b}" for b, folder in found.items()}


def _nullable(schema: StructType) -> dict:
    """As JSON; files may hold NULL in any column."""
    return StructType([StructField(f.name, f.dataType) for f in schema.fields]).jsonValue()


def _schema(props: dict) -> StructType:
    return StructType.fromJson(json.loads(props[SCHEMA_PROP]))


def rows_of_keys(spark: SparkSession, name: str, root: str, keys: Sequence[str], wanted: DataFrame) -> DataFrame:
    """Rows of a keyed table whose key is among ``wanted`` (the key columns, distinct): reads
    only the buckets that hold them."""
    props = _props(spark, name)
    count, schema = int(props[BUCKETS_PROP]), _schema(props)
    touched = [r[0] for r in wanted.select(_bucket(keys, count).alias("b")).distinct().collect()]
    folders = bucket_folders(spark, name, root, props)
    paths = [folders[b] for b in touched if b in folders]
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    a, b = rows.alias("a"), wanted.select(*keys).alias("b")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    return a.join(b, on=same, how="left_semi")


def merge_buckets(name: str, source: DataFrame, keys: Sequence[str], root: str,
                  order_desc: Sequence[str] | None = None, null_keys: str = "insert",
                  buckets: int = BUCKETS, props: dict | None = None,
                  unique: bool = False) -> tuple[int, dict[int, str], dict]:
    """Write the touched buckets of table ``name`` after a merge of ``source``, which holds a
    key once; no reader sees them yet.

    Returns the version, the folders of the written buckets and what ``switch_buckets`` needs.
    The rows are those of ``merge_frames``: source replaces target, new keys are added, other
    keys stay; with ``order_desc`` the newer row of a key wins whichever side it comes from, ties
    by the other columns, so batches may come again or in any order.  A row with a NULL key is
    added by every merge (``null_keys="insert"``, J6) or is a key like any other ("match").
    One shuffle of the touched buckets and the source, by bucket and share of a bucket: with more
    shuffle partitions than buckets, several tasks write a bucket, a file each, so a bucket may
    outgrow a task.  Rows with a NULL key that are added by every merge are dealt by
    their values.  Where the source has columns that the table lacks, all buckets are written.
    ``unique`` says that a NULL key occurs once too: with nothing to merge with, rows are not ranked then.
    """
    if null_keys not in ("insert", "match"):
        raise ValueError(f"unknown null_keys {null_keys!r}")
    spark, keys = source.sparkSession, list(keys)
    props = _props(spark, name) if props is None else props
    version = int(props.get(VERSION_PROP, 0)) + 1
    count = int(props.get(BUCKETS_PROP, buckets))
    home, folders = _table_root(name, root), bucket_folders(spark, name, root, props)
    if props and BUCKETS_PROP not in props:      # published whole before: its buckets are made now
        target, folders = spark.table(name), {}
    elif props:
        old = _schema(props)
        touched = set(folders)
        if set(source.columns) <= set(old.names):
            touched &= {r[0] for r in source.select(_bucket(keys, count).alias("b")).distinct().collect()}
        target = spark.read.schema(old).parquet(*[folders[b] for b in sorted(touched)]) if touched else None
    else:
        target = None
    both = source.withColumn("_from_source", F.lit(1))
    if target is not None:
        both = target.withColumn("_from_source", F.lit(0)).unionByName(both, allowMissingColumns=True)
    data = [c for c in both.columns if c != "_from_source"]
    first = list(order_desc) if order_desc else ["_from_source"]
    types = {f.name: f.dataType for f in both.schema.fields}
    ties = [c for c in data if c not in keys and c not in first and _orderable(types[c])]
    keep, share = F.col("_place") == 1, F.xxhash64(*keys, F.lit(1))
    if null_keys == "insert":
        keep = keep | ~_non_null(keys)
        share = F.when(_non_null(keys), share).otherwise(F.xxhash64(*first, *ties))
    shares = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // count)
    both = (both.withColumn("_bucket", _bucket(keys, count)).withColumn("_share", F.pmod(share, F.lit(shares)))
            .repartition("_bucket", "_share"))
    if target is not None or not unique:
        w = Window.partitionBy("_bucket", "_share", *keys).orderBy(*[F.col(c).desc_nulls_last() for c in first + ties])
        both = both.withColumn("_place", F.row_number().over(w)).filter(keep)
    merged = both.select(*data, "_bucket")
    folder = f"v{version:06d}-{uuid.uuid4().hex[:12]}"
    merged.write.mode("errorifexists").partitionBy("_bucket").parquet(f"{home}/{folder}")
    fs, path = _hadoop(spark, f"{home}/{folder}")
    new = {int(st.getPath().getName().split("=")[1]): folder
           for st in fs.listStatus(path) if st.getPath().getName().startswith("_bucket=")}
    if not new and not folders:                  # an empty table still has columns
        merged.drop("_bucket").write.mode("errorifexists").parquet(f"{home}/{folder}/_empty")
    now = {**_read_map(props.get(MAP_PROP + props.get(VERSION_PROP, ""), "")), **new}
    written = {b: f"{home}/{folder}/_bucket={b}" for b in new}
    return version, written, {"home": home, "map": now, "buckets": count, "old": props, "folder": folder,
                              "schema": merged.drop("_bucket").schema}


def switch_buckets(spark: SparkSession, name: str, version: int, plan: dict, batch_id: int | None = None,
                   props: dict | None = None) -> int:
    """Make written buckets the table's, in one change of the catalog; then delete bucket
    folders that only a version older than the last ``KEPT_VERSIONS`` named."""
    home, old = plan["home"], plan["old"]
    maps = {int(k.removeprefix(MAP_PROP)): v for k, v in old.items() if k.startswith(MAP_PROP)}
    maps[version] = _write_map(plan["map"])
    kept = {v: m for v, m in maps.items() if v > version - KEPT_VERSIONS}
    folders = [f"{f}/_bucket={b}" for b, f in sorted(plan["map"].items())]
    path = f"{home}/{{{','.join(folders)}}}" if len(folders) > 1 else f"{home}/{(folders or [plan['folder'] + '/_empty'])[0]}"
    switch(spark, name, version, path, batch_id,
           {**(props or {}), PATH_PROP: home, SCHEMA_PROP: json.dumps(_nullable(plan["schema"]), separators=(",", ":")), BUCKETS_PROP: str(plan["buckets"]),
            **{f"{MAP_PROP}{v}": m for v, m in kept.items()}}, view_path=path, old=old)
    named = {(f, b) for m in kept.values() for b, f in _read_map(m).items()}
    gone = {(f, b) for v, m in maps.items() if v not in kept for b, f in _read_map(m).items()} - named
    for f, b in sorted(gone):
        fs, folder = _hadoop(spark, f"{home}/{f}/_bucket={b}")
        fs.delete(folder, True)
    return version


def _hadoop(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def upsert(name: str, source: DataFrame, keys: Sequence[str], root: str,
           order_desc: Sequence[str] | None = None, batch_id: int | None = None,
           null_keys: str = "insert", source_unique: bool = False, buckets: int = BUCKETS,
           props: dict | None = None, before: dict | None = None) -> int:
    """Keyed upsert of ``source`` into table ``name`` (created when absent). Returns the version.

    Only the buckets that hold the source's keys are read and written.  ``source_unique`` says
    that a key occurs once already (after ``latest_per_key``); else that is checked first.
    """
    before = _props(source.sparkSession, name) if before is None else before
    # The source feeds the check, the list of buckets and the write: keep it cached for the
    # duration instead of evaluating it again (a lost block is recomputed from lineage).
    # A first load of unique rows only writes them.
    several = bool(before) or not source_unique
    source = source.persist() if several else source
    try:
        if not source_unique:
            assert_unique_source(source, keys)
        version, _, plan = merge_buckets(name, source, keys, root, order_desc, null_keys, buckets, before,
                                         unique=source_unique)
        return switch_buckets(source.sparkSession, name, version, plan, batch_id, props)
    finally:
        if several:
            source.unpersist()
