"""Session helpers.

Library functions never create a session; they take DataFrames.  These helpers
build the local session used by tests and the bench, and resolve the shared
folder (``spark.checkpoint.dir``) used for checkpoints and scratch output.
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "bikelake", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench: UTC, no UI, AQE on."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect client."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as is.  Only when it is unset (local tests) a private
    folder is created and registered.
    """
    sc = _context(spark)
    d = spark.conf.get(CHECKPOINT_CONF, None)
    if not d and sc is not None:
        d = sc.getConf().get(CHECKPOINT_CONF, None)
    if not d and sc is not None and not sc.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_CONF} must name a folder that driver and executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="bikelake-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/bikelake-scratch/{name}-{uuid.uuid4().hex[:12]}"


def side_by_side(spark: SparkSession, *steps) -> list:
    """Results of steps that do not read each other's output, each run in a thread of its own:
    their jobs share the cluster, so cores that one leaves idle serve another."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20,
               max_partition_bytes: int = 256 << 20) -> dict:
    """Session settings sized to the input volume (for ``spark-submit --conf`` / builder).

    Shuffle partitions are chosen so that each holds about ``target_partition_bytes``
    of the largest shuffled input (AQE coalesces small ones and splits skewed
    ones); scan splits stay at ``max_partition_bytes`` so a task's input fits
    comfortably in executor memory.  100 TB -> ~370k shuffle partitions.
    """
    parts = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(max_partition_bytes),
        "spark.sql.session.timeZone": "UTC",
    }
