"""A corpus pipeline over ``documents``: language ID, SimHash near-dedup, secret scans,
mixing to target weights, packing into training sequences.

Each stage is a function (spark, docs, sf_dir) -> DataFrame calling one operator; its result
is written as Parquet and read again as the next stage's documents. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.llm import langid, mixing, packing, secrets, simhash
from shelfscope.llm.common import documents, positional, prepare, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language: null texts and texts without a letter go."""
    prepare(spark)
    d, name = positional(docs)
    model = langid.train(docs, where=~langid.held_out())
    if not model[0]:                                  # nothing to learn from: one language for all
        model = (["any"], np.zeros(1), np.zeros((1, len(langid.ORDERS) << langid.BITS), np.float32))
    kept = langid.predict(d, model, d.columns, text=name["text"])
    return kept.where("lang_pred != 'und'").select(*d.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, one without an
    id only where none has one; of different rows with this id, the one with the least row
    hash. A row is known by two 64-bit hashes of all its columns, so ids may be null or shared."""
    prepare(spark)
    d, name = positional(docs)
    h = ["_h1", "_h2"]
    cols = [*d.columns, *[F.col(c).isNull() for c in d.columns]]   # xxhash64 passes over nulls
    rows = d.select("*", *[F.xxhash64(F.lit(k), *cols).alias(k) for k in h])
    fps = written(simhash.fingerprints(
        rows.select(F.col(name["doc_id"]).alias("doc_id"), F.col(name["text"]).alias("text"), *h), keep=tuple(h)),
        "pipeline-fingerprints")
    group = simhash.fingerprint_groups(fps).select("fp", "c")
    same = fps.groupBy("fp", "doc_id", *h).agg(F.count("*").alias("n"))
    first = written(same.join(group, "fp").groupBy("c").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *h, "n")).alias("_f")).select(
        *[f"_f.{k}" for k in h], "_f.n"), "pipeline-survivors")
    once = rows.join(first.where("n = 1"), h, "left_semi")
    again = rows.join(first.where("n > 1"), h, "left_semi").dropDuplicates(h)
    return once.unionByName(again).select(*d.columns).toDF(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark."""
    prepare(spark)
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their places in sequences."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", secret_scan),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL can express neither the hashed classifier nor the column generation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
