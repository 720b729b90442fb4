"""Shared pieces of the training-data operators: tables in the shared folder, word
expressions, blocked pair comparison inside buckets and connected components."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_conf, checkpoint_dir

WS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage, is
    computed once, and survives the loss of executors."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def positional(docs: DataFrame):
    """``docs`` with its columns named by position, so no column of the caller's clashes with
    an operator's; and the new name of each old one."""
    d = docs.toDF(*[f"_d{i}" for i in range(len(docs.columns))])
    return d, dict(zip(docs.columns, d.columns))


def words(text: Column) -> Column:
    """The words of a text as an array; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def texts(batch: pa.RecordBatch, col: str) -> list:
    return batch.column(col).to_pylist()


# -- comparison of all pairs of a bucket, in bounded blocks -------------------------------

BLOCK = 1024


def local_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the links i-j."""
    lab = np.arange(n)
    while len(i):
        low = np.minimum(lab[i], lab[j])
        new = lab.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == lab).all():
            break
        lab = new
    return lab


def block_groups(rows: DataFrame, key: list[str], member: str, block: int = BLOCK) -> DataFrame:
    """Rows of every bucket with two members or more, dealt to block pairs.

    A bucket of any size is cut into blocks of about ``block`` rows by a hash of ``member``;
    each pair of blocks is a group of its own (columns bi, bj), so no task holds more than
    two blocks at once. ``blk`` is the block of the row.
    """
    sizes = (rows.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1")
             .select(*[F.col(k).alias(f"_{k}") for k in key],
                     F.ceil(F.col("_n") / block).cast("int").alias("_nb")))
    cond = [rows[k] == sizes[f"_{k}"] for k in key]
    return (rows.join(sizes, cond).drop(*[f"_{k}" for k in key])
            .withColumn("blk", F.pmod(F.xxhash64(F.lit(7), member), F.col("_nb")).cast("int"))
            .withColumn("_o", F.explode(F.expr("sequence(0, _nb - 1)")))
            .withColumn("bi", F.least("blk", "_o")).withColumn("bj", F.greatest("blk", "_o"))
            .drop("_o", "_nb"))


def map_groups(rows: DataFrame, by: list[str], fn: Callable[[dict], dict | None], schema: str) -> DataFrame:
    """``fn`` on every group of ``by``, many groups a batch: rows are hashed and sorted by
    the group, and the groups are cut out of the Arrow batches as numpy columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
            if not t.num_rows:
                continue
            at = starts(t)
            if len(at) > 1:
                yield from cut(t.slice(0, at[-1]), at[:-1])
            rest = t.slice(at[-1])
        if rest is not None and rest.num_rows:
            yield from cut(rest, [0])

    def starts(t: pa.Table) -> list:
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for k in by:
            v = t.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new).tolist()

    def cut(t: pa.Table, at: list) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        cols, lists = {}, {}
        for f in t.schema:
            c = t.column(f.name).combine_chunks()
            if pa.types.is_list(f.type):               # lists of one length within a group
                lists[f.name] = c.values.to_numpy(), c.offsets.to_numpy()
            else:
                cols[f.name] = c.to_numpy(zero_copy_only=False)
        out: dict[str, list] = {}
        size = 0
        for lo, hi in zip(at, [*at[1:], t.num_rows]):
            g = {k: v[lo:hi] for k, v in cols.items()}
            g |= {k: v[off[lo]:off[hi]].reshape(hi - lo, -1) for k, (v, off) in lists.items()}
            r = fn(g)
            if r is None:
                continue
            for k, v in r.items():
                out.setdefault(k, []).append(v)
            size += len(next(iter(r.values())))
            if size > 50_000:
                yield pa.RecordBatch.from_pydict({k: np.concatenate(v) for k, v in out.items()})
                out, size = {}, 0
        if size:
            yield pa.RecordBatch.from_pydict({k: np.concatenate(v) for k, v in out.items()})

    return rows.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, schema)


# -- connected components -------------------------------------------------------------------

def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable from every node that has an edge.

    Alternating large-star and small-star rounds; every round is a few joins on the node and
    is written to the shared folder. Nothing is gathered on the driver but two sums.
    """
    e = written(edges.where(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    last = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low2.select("u", F.col("m").alias("v"))).distinct())
        e = written(small, "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if tuple(now) == last:
            break
        last = tuple(now)
    else:
        raise RuntimeError("components: no fixed point")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on. Rows carry whole texts, so small Arrow batches
    keep Python workers small."""
    apply_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:  # executors' Python workers import this package
        _SHIPPED.add(sc.applicationId)
        package = Path(__file__).resolve().parents[1]
        to = Path(tempfile.mkdtemp(prefix="shelfscope-py-")) / "shelfscope-py.zip"
        with zipfile.ZipFile(to, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(to))


_SHIPPED: set[str] = set()
