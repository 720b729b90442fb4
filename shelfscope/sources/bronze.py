"""File sources for landed data (SRC-01 .. SRC-04, SRC-06 .. SRC-10)."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import valid_barcode_length
from ..session import path_exists


def with_field(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    """A new schema with one more field (``StructType.add`` changes its own object)."""
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def read_bronze(spark: SparkSession, base: str, schema: T.StructType | None = None,
                stores: Sequence[str] | None = None) -> DataFrame:
    """SRC-01: Hive-partitioned Parquet, union by name across files (mergeSchema);
    a store filter is a partition filter (only that store's directories are listed)."""
    r = spark.read.option("basePath", base).option("mergeSchema", True)
    df = (r.schema(schema) if schema else r).parquet(base)
    if stores:
        df = df.where(F.col("supermarket").isin(*stores))
    return df


def exclude_in_flight(df: DataFrame, store: str, as_of: dt.date) -> DataFrame:
    """SRC-02: drop the as-of day of a store whose collection is still running.
    Typed predicate on partition columns only, so it stays a partition filter."""
    day = F.make_date("year", "month", "day")
    return df.where((F.col("supermarket") != store) | (day < F.lit(as_of)))


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """SRC-03: JSON lines with an explicit schema plus the source file name."""
    return spark.read.schema(schema).json(paths).withColumn("filename", F.col("_metadata.file_path"))


def discover_jsonl(spark: SparkSession, base: str, schema: T.StructType, batch_glob: str = "*.json*") -> DataFrame:
    """SRC-04: prefer consolidated ``*_full.jsonl`` files (gzip or not); without any, read the
    micro-batch files (``batch_glob``); a missing folder reads as empty."""
    def read(glob: str) -> DataFrame:
        return (spark.read.schema(schema).option("recursiveFileLookup", True)
                .option("pathGlobFilter", glob).option("ignoreMissingFiles", True).json(base)
                .withColumn("filename", F.col("_metadata.file_path")))
    if not path_exists(spark, base):
        return spark.createDataFrame([], with_field(schema, "filename", T.StringType()))
    full = read("*_full.jsonl{,.gz}")
    return read(batch_glob) if full.isEmpty() else full


def backfill_metadata(df: DataFrame) -> DataFrame:
    """SRC-07: fill missing lineage columns from the file path (supermarket=/region=
    segments), copy scraped_at, NULL postal code / hub id when absent."""
    path = F.col("_metadata.file_path")
    seg = lambda k: F.nullif(F.regexp_extract(path, rf"{k}=([^/\\]+)", 1), F.lit(""))
    cols = set(df.columns)
    out = df
    for name, fill in [("_metadata_supermarket", seg("supermarket")), ("_metadata_region", seg("region")),
                       ("_metadata_run_id", F.concat(F.lit("backfill_"), F.coalesce(seg("supermarket"), F.lit("x"))))]:
        out = out.withColumn(name, F.coalesce(F.col(name), fill) if name in cols else fill)
    for name in ("_metadata_postal_code", "_metadata_hub_id"):
        if name not in cols:
            out = out.withColumn(name, F.lit(None).cast("string"))
    return out


def migrate_legacy(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                   start: dt.date, end: dt.date) -> tuple[DataFrame, DataFrame]:
    """SRC-06: legacy JSON lines -> (rows to land, counts).

    Malformed lines are kept in a corrupt-record column and counted; records
    failing the basic rules are counted as invalid; duplicates by (productId,
    scraped_at) keep the first (smallest file, then line position); then the
    date range filter.
    """
    s = with_field(schema, "_corrupt", T.StringType())
    raw = (spark.read.schema(s).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
           .json(paths).withColumn("_file", F.col("_metadata.file_path"))
           .withColumn("_pos", F.monotonically_increasing_id()))
    bad_json = F.col("_corrupt").isNotNull()
    valid_rule = (F.col("productId").isNotNull() & (F.trim("productId") != "")
                  & F.col("_metadata_scraped_at").isNotNull())
    tagged = raw.withColumn("_state", F.when(bad_json, "malformed").when(~valid_rule, "invalid").otherwise("valid"))
    valid = tagged.where(F.col("_state") == "valid")
    from ..operators.dedup import first_per_key
    keep = [c for c in valid.columns if c not in ("productId", "_metadata_scraped_at")]
    dedup = first_per_key(valid, ["productId", "_metadata_scraped_at"], ["_file", "_pos"], keep=keep)
    ts = F.col("_metadata_scraped_at").try_cast("timestamp")
    landed = dedup.where(F.to_date(ts).between(F.lit(start), F.lit(end))).drop("_corrupt", "_file", "_pos", "_state")
    counts = tagged.groupBy("_state").agg(F.count(F.lit(1)).alias("records")).withColumnRenamed("_state", "state")
    dups = (valid.groupBy("productId", "_metadata_scraped_at").agg(F.count(F.lit(1)).alias("n"))
                 .agg(F.lit("duplicate").alias("state"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("records")))
    return landed, counts.unionByName(dups)


GRADES = ["a", "b", "c", "d", "e"]


def read_barcode_parquet(spark: SparkSession, path: str, codes: DataFrame) -> DataFrame:
    """SRC-08: bulk barcode-DB Parquet: first product_name text of the list,
    grade whitelist, only the wanted codes (semi join), valid lengths."""
    df = spark.read.parquet(path)
    g = F.lower(F.col("nutriscore_grade"))
    out = df.select(
        "code", F.get(F.col("product_name"), 0)["text"].alias("product_name"), "brands", "categories", "quantity",
        "countries", F.when(g.isin(*GRADES), g).alias("nutriscore_grade"), "image_url")
    return out.where(valid_barcode_length(F.col("code"))).join(codes.select("code"), "code", "left_semi")


def read_barcode_tsv(spark: SparkSession, path: str, codes: DataFrame) -> DataFrame:
    """SRC-09: bulk barcode-DB TSV (optionally gzip: not splittable, so the read is
    repartitioned before the join); every column read as text."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    if any(f.endswith((".gz", ".zst")) for f in df.inputFiles()):
        df = df.hint("rebalance")
    g = F.lower(F.col("nutriscore_grade"))
    out = df.select("code", "product_name", "brands", "categories", "quantity", "countries",
                    F.when(g.isin(*GRADES), g).alias("nutriscore_grade"), "image_url")
    return out.where(valid_barcode_length(F.col("code"))).join(codes.select("code"), "code", "left_semi")


DELTA_NAME = re.compile(r"_(\d+)_(\d+)\.json(\.gz)?$")
DELTA_SCHEMA = ("code string, product_name string, brands string, nutriscore_grade string, last_modified_t long, "
                "_corrupt string")


def delta_files(spark: SparkSession, base: str, after: int) -> list[tuple[int, int, str]]:
    """(start, end, path) of the delta files ``..._<start>_<end>.json[.gz]`` whose time range
    ends after ``after``, oldest first. Chosen by name from one listing: no file is opened."""
    if not path_exists(spark, base):
        return []
    p = spark._jvm.org.apache.hadoop.fs.Path(base)
    out = []
    for f in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p):
        m = DELTA_NAME.search(f.getPath().getName())
        if m and int(m[2]) > after:
            out.append((int(m[1]), int(m[2]), f.getPath().toString()))
    return sorted(out)


def delta_records(spark: SparkSession, files: Sequence[tuple[int, int, str]],
                  codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The wanted records of delta files with their file's end (``delta_end``), and the
    malformed lines with their file and what code they show. Names come as a list or a text;
    'unknown' is no value."""
    reader = spark.read.schema(DELTA_SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    if files:
        raw = reader.json([f[2] for f in files]).withColumn("_file", F.col("_metadata.file_path"))
    else:
        raw = spark.createDataFrame([], DELTA_SCHEMA + ", _file string")
    bad = raw.where(F.col("_corrupt").isNotNull()).select(F.col("_corrupt").alias("line"), F.col("_file").alias("file"), "code")
    end = F.regexp_extract("_file", r"_\d+_(\d+)\.json(?:\.gz)?(?:/[^/]*)?$", 1).try_cast("long")
    clean = lambda c: F.when(F.lower(F.trim(c)) == "unknown", None).otherwise(c)
    name = F.when(F.col("product_name").startswith("["), F.get_json_object("product_name", "$[0].text")).otherwise(
        F.col("product_name"))
    recs = raw.where(F.col("_corrupt").isNull()).select(
        "code", clean(name).alias("product_name"), clean(F.col("brands")).alias("brands"),
        clean(F.lower("nutriscore_grade")).alias("nutriscore_grade"), "last_modified_t", end.alias("delta_end"))
    return recs.join(codes.select("code"), "code", "left_semi"), bad


def read_barcode_deltas(spark: SparkSession, base: str, watermark: int,
                        codes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """SRC-10: only delta files ending after the watermark are read. Returns (records, new
    watermark as a one-row frame, malformed lines)."""
    files = delta_files(spark, base, watermark)
    recs, bad = delta_records(spark, files, codes)
    new = max([watermark, *[f[1] for f in files]])
    return recs.drop("delta_end"), spark.createDataFrame([(new,)], "last_timestamp long"), bad
