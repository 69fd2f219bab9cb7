"""Shared helpers: table access, written cuts of the lineage, connected components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikelake.session import scratch_path


BATCH_BYTES = 4 << 20     # of an Arrow batch; a larger row is a batch of its own
READ_ROWS = 1024          # of a batch of the parquet reader

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session's executors, wherever
    the driver's copy lies (once per application; Spark's file server carries it)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    name = Path(tempfile.mkdtemp(prefix="bikelake-zip-")) / "bikelake_code.zip"
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(name))
    _SHIPPED.add(app)


def small_batches(spark: SparkSession) -> None:
    """From now on this session reads whole texts, and hands them to Python, a few MB at a time.
    The default of 10,000 rows is tens of MB of texts a batch, which the executor and its Python
    workers hold several times over and keep for later."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, and
    every later use reads files that all executors share."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_uri(spark: SparkSession, folder: str) -> str:
    """``folder`` with scheme and authority, as Spark resolves it: a folder without a scheme
    lies in Hadoop's default file system, not on each executor's own disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(path).toString().rstrip("/")


def open_folder(uri: str):
    """File system and path of a folder URI, for files that are not tables (in tasks)."""
    from pyarrow import fs
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else uri)


def lookup_spread(rows: DataFrame, found: DataFrame, keys: list[str], spread: list[str], salts: int = 256) -> DataFrame:
    """Left join of ``rows`` to ``found`` (one row per key) where one key may hold a third of
    ``rows``: they are dealt by key and a salt of ``spread``, and ``found`` is first joined to
    the (key, salt) pairs that occur, at most ``salts`` per key."""
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).alias("__salt")
    rows = rows.select("*", salt)
    pairs = rows.select(*keys, "__salt").distinct().join(found, keys)
    return rows.join(pairs, [*keys, "__salt"], "left").drop("__salt")


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of every text of an Arrow string column; null counts as empty."""
    for v in column.cast(pa.binary()):
        yield v.as_py() or b""


def batch_of(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type)
         for c, f in zip(columns, schema)], schema=schema)


# ---------------------------------------------------------------- components

def _contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node) of the components of one batch of edges."""
    nodes, idx = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(nodes))
    i, j = idx[:len(a)], idx[len(a):]
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = np.minimum(new, new[label])
        while True:
            hop = new[new]
            if np.array_equal(hop, new):
                break
            new = hop
        if np.array_equal(new, label):
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def _contract_partition(batches):
    """Replace each partition's edges by the stars of their components, a bounded number of
    edges at a time (what one pass leaves is contracted further by the global rounds)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held, n = [], 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        n += batch.num_rows
        if n >= 2_000_000:
            held, n = [_contract(*(np.concatenate(x) for x in zip(*held)))], 0
    if held:
        a, b = _contract(*(np.concatenate(x) for x in zip(*held)))
        for k in range(0, len(a), 100_000):
            yield batch_of(schema, [a[k:k + 100_000], b[k:k + 100_000]])


def components(spark: SparkSession, edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of undirected ``edges`` (first two columns, 64-bit ids).

    Returns ``(node, root)``: every node of an edge, with the smallest node it can reach.
    Alternates the large-star and small-star steps until the edges are stars.  Every step is
    two combinable aggregations and one join per node; a hub's edges are only rows of that
    join, which the adaptive skew join splits.  Rounds are cut by written tables.  Empty
    input gives an empty result; loops and repeated edges are ignored.  Edges are small rows, so a
    step is written by an eighth of the shuffle partitions, but two tasks a core at least.
    """
    few = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
    a, b = edges.columns[:2]
    e = (edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
         .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b"))
    e = written(spark, e.coalesce(few).mapInArrow(_contract_partition, "a long, b long"), name)
    # From here every edge is (a, b) with b < a.
    before = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before is not None and tuple(now) == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        if now[0] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(now)
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        # large star: larger neighbours of a node point to its smallest neighbour or itself
        big = (both.join(low, "a").filter("b > a")
               .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
               .filter("a <> b").distinct())
        # small star: smaller neighbours of a node, and the node, point to the smallest
        low2 = big.groupBy("a").agg(F.min("b").alias("m"))
        small = (big.join(low2, "a")
                 .select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")),
                                           F.struct(F.col("b").alias("x"), F.col("m").alias("y"))))
                         .alias("s"))
                 .select(F.col("s.x").alias("a"), F.col("s.y").alias("b"))
                 .filter("a <> b").distinct())
        e = written(spark, small.coalesce(few), name)
