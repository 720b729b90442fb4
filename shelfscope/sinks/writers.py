"""Sinks and materialisations (SNK-01 .. SNK-10).

Every writer takes an explicit target path and is idempotent for a given input
(overwrite, or dynamic overwrite of the touched partitions).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from .published import Published, Version

BRONZE_PARTITIONS = ("supermarket", "region", "year", "month", "day")


def inject_metadata(df: DataFrame, metadata: Mapping[str, object]) -> DataFrame:
    """SNK-01: lineage columns flattened as ``_metadata_<key>`` (one withColumn per key)."""
    out = df
    for k, v in metadata.items():
        out = out.withColumn(f"_metadata_{k}", F.lit(v))
    return out


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str] = BRONZE_PARTITIONS,
                      compression: str = "zstd", mode: str = "overwrite", clustered: bool = False) -> str:
    """SNK-01: Hive-partitioned Parquet. Rows are clustered on the partition
    columns first, unless they come ``clustered``, so a directory gets few files; the rebalance hint
    lets AQE split large partitions over several writers."""
    ((df if clustered else df.hint("rebalance", *partition_cols)).write.mode(mode).option("compression", compression)
       .partitionBy(*partition_cols).parquet(path))
    return path


def consolidate(spark: SparkSession, src: str, dst: str, partition_cols: Sequence[str] = BRONZE_PARTITIONS) -> str:
    """SNK-02: compaction — many small batch files -> few files per partition, rows
    sorted within it; written to a new location (atomic swap by path)."""
    df = spark.read.option("basePath", src).parquet(src)
    (df.hint("rebalance", *partition_cols).sortWithinPartitions(*partition_cols)
       .write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_cols).parquet(dst))
    return dst


def export_zstd(df: DataFrame, path: str) -> str:
    """SNK-03: export with ZSTD compression."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def append(df: DataFrame, path: str) -> str:
    """SNK-06: append to a table (created by the first append)."""
    df.write.mode("append").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """SNK-07: CSV with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json_report(report: DataFrame, path: str) -> str:
    """SNK-08: a one-row report (nested structs) as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)
    return path


# A gzip file is read by one task, so it holds so many lines at most.
GZIP_LINES = 500_000


def gzipped(df: DataFrame) -> DataFrameWriter:
    """A writer of gzip text or JSON files of bounded size."""
    return df.write.option("compression", "gzip").option("maxRecordsPerFile", GZIP_LINES)


def write_full_jsonl(df: DataFrame, path: str, gzip: bool = False) -> str:
    """Consolidated JSON lines: the files SRC-04 prefers, named ``..._full.jsonl`` (``..._full.jsonl.gz``)."""
    (gzipped(df) if gzip else df.write).mode("overwrite").json(path)
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.listStatus(folder):
        name = f.getPath().getName()
        plain = name.removesuffix(".gz")
        if plain.endswith(".json"):
            to = spark._jvm.org.apache.hadoop.fs.Path(folder, plain.removesuffix(".json") + "_full.jsonl" + name[len(plain):])
            if not fs.rename(f.getPath(), to):
                raise OSError(f"cannot name {to}")
    return path


def write_bundle(spark: SparkSession, reports: Mapping[str, DataFrame], base: str) -> DataFrame:
    """SNK-09: one directory per named result set; empty ones are skipped and a
    failing one does not stop the rest. Returns (report, rows, status)."""
    rows = []
    for name, df in reports.items():
        try:
            out = f"{base.rstrip('/')}/{name}"
            df.write.mode("overwrite").parquet(out)
            n = spark.read.parquet(out).count()
            rows.append((name, n, "written" if n else "empty"))
        except Exception as e:  # noqa: BLE001 - one report must not stop the bundle
            rows.append((name, None, f"failed: {type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"))
    return spark.createDataFrame(rows, "report string, rows long, status string")


# -- SNK-08 with SNK-10: a run's outputs and its marker ---------------------------------------

def publish_run(state: Published, outputs: Mapping[str, Callable[[], DataFrame] | DataFrame], run_at: dt.datetime,
                version: str, status: str = "completed") -> Version:
    """Writes all outputs of a run, then makes them and the freshness marker visible in one step.

    An output that fails raises, and readers keep seeing the run before: its outputs, its
    marker. The marker has the run's time, status and version, and the rows of each output."""
    now = state.current()
    parts = {name: state.stage(name, df() if callable(df) else df) for name, df in outputs.items()}
    rows = {name: state.spark.read.parquet(f"{state.base}/{p}").count() for name, p in parts.items()}
    return state.commit(now, {name: [p] for name, p in parts.items()}, {
        "marker": {"last_pipeline_run": run_at.isoformat(), "status": status, "version": version, "rows": rows}})


def read_marker(state: Published) -> DataFrame:
    """SNK-10: (last_pipeline_run, status, version, output, rows) of the last published run."""
    m = state.current().values.get("marker")
    rows = [(dt.datetime.fromisoformat(m["last_pipeline_run"]), m["status"], m["version"], name, n)
            for name, n in sorted(m["rows"].items())] if m else []
    return state.spark.createDataFrame(rows, "last_pipeline_run timestamp, status string, version string, output string, rows long")


def write_marker(spark: SparkSession, path: str, run_at: dt.datetime, status: str, version: str) -> str:
    """SNK-10: freshness marker, a one-row table overwritten per run."""
    spark.createDataFrame([(run_at, status, version)],
                          "last_pipeline_run timestamp, status string, version string") \
         .write.mode("overwrite").parquet(path)
    return path


# -- SNK-05: schema routing ----------------------------------------------------------------------

def schema_for(target: str, custom: str, user: str = "dev") -> str:
    """SNK-05: prod / ci write to the custom schema, dev to a personal one."""
    return custom if target in ("prod", "ci") else f"{user}_{custom}"


class Target:
    """Where a build's models go: ``base``/<schema>/<model>, the schema by target and user."""

    def __init__(self, spark: SparkSession, base: str, target: str, user: str = "dev"):
        self.spark, self.base, self.target, self.user = spark, base.rstrip("/"), target, user

    def path(self, schema: str, model: str) -> str:
        return f"{self.base}/{schema_for(self.target, schema, self.user)}/{model}"

    def build(self, models: Mapping[str, tuple[str, DataFrame]]) -> None:
        """Writes every model (name -> its custom schema and rows) to this target."""
        for name, (schema, df) in models.items():
            df.write.mode("overwrite").parquet(self.path(schema, name))

    def read(self, schema: str, model: str) -> DataFrame:
        return self.spark.read.parquet(self.path(schema, model))
