"""Spark session and lineage helpers."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Session settings every job relies on: UTC wall clock (timestamps have no
# zone in the data model), ANSI semantics, AQE for runtime re-planning and
# skew handling.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join is split even where what follows has to be shuffled for it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # A whole-stage method above HotSpot's 8000-byte limit is never JIT-compiled and runs
    # interpreted; at this limit Spark instead falls back to per-expression code for
    # that stage, which the JIT does compile (wide nested projections hit it).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # AQE sizes shuffle partitions from measured output; these are its targets
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
}


def cluster_conf(input_bytes: int, cores: int) -> dict:
    """Settings for a run over ``input_bytes`` on ``cores`` executor cores: enough
    initial shuffle partitions for ~256 MB each (AQE coalesces small ones and
    splits skewed ones), never fewer than 2 x cores."""
    parts = max(2 * cores, int(input_bytes // (256 * 1024 * 1024)) + 1)
    return {"spark.sql.shuffle.partitions": str(parts),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts)}


def build_session(master: str | None = None, app: str = "shelfscope",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  input_bytes: int | None = None, cores: int | None = None) -> SparkSession:
    """A session with the settings above; ``input_bytes`` and ``cores`` size its shuffles
    (``cluster_conf``), ``shuffle_partitions`` overrides that."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if input_bytes and cores:
        for k, v in cluster_conf(input_bytes, cores).items():
            b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Pin the settings results depend on, on a session made by someone else."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin",
              "spark.sql.sources.partitionOverwriteMode", "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(k, BASE_CONF[k])


SPLIT_BYTES = 16 * 1024 * 1024


def size_work(spark: SparkSession, folder: str) -> None:
    """Splits and shuffle partitions for the tables in ``folder``, on a session made by someone else.

    A compact Parquet row becomes a nested record many times as wide, so a task that takes
    128 MB of file, or a 200th of a large shuffle, sorts more than its memory holds and spills.
    Splits are small, and AQE starts from one shuffle partition per 2 MB of input (never fewer than
    the session has) and merges what turns out small. A partitioned write into few folders keeps
    their files open in place of sorting the rows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = fs.getContentSummary(path).getLength() if fs.exists(path) else 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // (2 * 1024 * 1024))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(2 * SPLIT_BYTES))
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "8")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir``, set by the cluster). Only
    when unset on a local master — tests, trial runs — a private scratch folder is
    created, and removed when the process ends; a cluster without it is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="shelfscope-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A table location under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, column-pruned by its
    readers, and safe when executors are lost."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *work: Callable) -> Sequence:
    """The results of independent pieces of work whose jobs run side by side, so that the small
    stages of one fill the cores that another leaves idle. The first error is raised."""
    with ThreadPoolExecutor(len(work)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(w)) for w in work]]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there. Other errors (permissions, a store that is down) are raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def is_local(spark: SparkSession) -> bool:
    """One process: local[...], but not local-cluster[...]."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None
