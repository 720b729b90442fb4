"""Embedding near-dedup: cross-polytope hashing after fast pseudo-random rotations, with
multiprobe buckets and verified pairs.

A rotation is three rounds of random signs and a fast Walsh-Hadamard transform; its hash is
the signed axis nearest to the rotated vector. A bucket joins ``axes`` rotations. A vector
lives in its own bucket of each table and also probes the buckets with the next-best axes.
Pairs that meet (one at home, the other at home or probing) are verified by their cosine in
double precision. Links found this way give the components; within a component all pairs are
then verified, so a vector's links are counted once each whatever tables found them.

Equal vectors are joined first and carry their number, so copies never meet one another.
Buckets and components of any size are compared in block pairs of bounded size; what leaves
a block is one edge, or one count, per vector.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
link with nothing and are their own component, kept; vectors of different lengths never
link; components of any finite size count (each vector is scaled before it is squared);
repeated rows (same id, same vector) count as links of one another, and rows that share an id
but not the vector are compared like any others. A null id is no smallest id: rows without
an id are kept only where no vector they reach has one, and their component_id is then null.
Columns beside the two named are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_groups, components, local_labels, map_groups, written


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (their length a power of two)."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(-1, n)
        h *= 2
    return x


def rotations(x: np.ndarray, number: int, seed: int) -> list[np.ndarray]:
    """``number`` pseudo-random rotations of the rows, zero-padded to a power of two."""
    n = 1 << max(0, x.shape[1] - 1).bit_length()
    x = np.pad(x, ((0, 0), (0, n - x.shape[1])))
    out = []
    for k in range(number):
        sign = np.random.default_rng([seed, k, n]).choice([-1.0, 1.0], (3, n))
        y = x
        for s in sign:
            y = hadamard(y * s) / np.sqrt(n)
        out.append(y)
    return out


def buckets(x: np.ndarray, tables: int, axes: int, probes: int, seed: int):
    """(row, table, bucket, home) of all rows: the home bucket, and the ``probes`` nearest
    buckets that differ from it in one axis."""
    n = len(x)
    rot = rotations(x, tables * axes, seed)
    width = 2 * rot[0].shape[1]
    most = min(probes, width - 1)                      # very short vectors have fewer axes
    for t in range(tables):
        key, options = np.zeros(n, np.int64), []
        for a in range(axes):
            y = rot[t * axes + a]
            both = np.concatenate([y, -y], axis=1)
            top = np.argpartition(-both, most, axis=1)[:, :most + 1]
            worth = np.take_along_axis(both, top, axis=1)
            order = np.argsort(-worth, axis=1, kind="stable")
            top, worth = np.take_along_axis(top, order, axis=1), np.take_along_axis(worth, order, axis=1)
            scale = width ** a
            key += top[:, 0] * scale
            options.append(((top[:, 1:] - top[:, :1]) * scale, worth[:, :1] - worth[:, 1:]))
        yield np.arange(n), np.full(n, t, np.int32), key, np.ones(n, bool)
        shift, loss = np.concatenate([o[0] for o in options], 1), np.concatenate([o[1] for o in options], 1)
        best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        near = (key[:, None] + np.take_along_axis(shift, best, axis=1)).ravel()
        yield np.repeat(np.arange(n), best.shape[1]), np.full(len(near), t, np.int32), near, np.zeros(len(near), bool)


def unit(x: np.ndarray) -> np.ndarray:
    """The rows at length one. They are scaled by a power of two first, which is exact, so that
    no square overflows or vanishes."""
    x = x.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def linked(g: dict, threshold: float, pick=None):
    """Index pairs of the block group with cosine at or above the threshold."""
    x, blk = unit(g["v"]), g["blk"]
    same = g["bi"][0] == g["bj"][0]
    left = np.arange(len(x)) if same else np.flatnonzero(blk == g["bi"][0])
    right = left if same else np.flatnonzero(blk == g["bj"][0])
    out = []
    for lo in range(0, len(left), 256):
        part = left[lo:lo + 256]
        near = np.einsum("id,jd->ij", x[part], x[right]) >= threshold if len(right) < 8 else x[part] @ x[right].T >= threshold
        if pick is not None:
            near &= pick[part][:, None] | pick[right][None, :]
        i, j = np.nonzero(near)
        i, j = part[i], right[j]
        if same:
            i, j = i[i < j], j[i < j]
        out.append((i, j))
    if not out:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate([i for i, _ in out]), np.concatenate([j for _, j in out])


def near_vectors(rows: DataFrame, threshold: float = 0.95, tables: int = 10, axes: int = 2, probes: int = 6,
                 seed: int = 3, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per vector."""
    v = F.col(vec_col).cast("array<double>")
    fine = (F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)
            & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))
    d = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.when(fine, v).alias("v"))
    # equal vectors once, known by a number of their own (ids may be null or shared); -0.0 counts as 0.0
    whole = written(d.withColumn("v", F.transform("v", lambda x: x + 0.0)), "vectors")
    reps = written(whole.where("v is not null").groupBy("v").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("copies")).select(
        F.monotonically_increasing_id().alias("rep"), "v", "low", "copies", F.size("v").alias("dim")), "vectors-distinct")

    def hashed(batches):
        for b in batches:
            ids, dim = b.column(0).to_numpy(), b.column(2).to_numpy()
            offsets = b.column(1).offsets.to_numpy()
            flat = b.column(1).values.to_numpy()
            for k in np.unique(dim):
                at = np.flatnonzero(dim == k)
                x = flat[offsets[at][:, None] + np.arange(k)]
                for row, t, key, home in buckets(unit(x), tables, axes, probes, seed):
                    yield pa.RecordBatch.from_pydict({
                        "rep": ids[at][row], "dim": np.full(len(row), k, np.int32), "t": t, "k": key, "home": home})

    # a bucket matters if it has a member at home and another member
    keyed = written(reps.select("rep", "v", "dim").mapInArrow(
        hashed, "rep long, dim int, t int, k long, home boolean"), "vectors-buckets")
    live = keyed.groupBy("dim", "t", "k").agg(F.max("home").alias("h"), F.count("*").alias("n")).where(
        "h and n > 1").select("dim", "t", "k")
    met = block_groups(keyed.join(live, ["dim", "t", "k"]), ["dim", "t", "k"], "rep")

    def edges(g: dict) -> dict | None:
        i, j = linked(g, threshold, g["home"])
        if not len(i):
            return None
        lab = local_labels(len(g["rep"]), i, j)
        at = np.flatnonzero(lab != np.arange(len(lab)))
        return {"a": g["rep"][at], "b": g["rep"][lab[at]]}

    by = ["dim", "t", "k", "bi", "bj"]
    found = map_groups(met.join(reps.select("rep", "v"), "rep").select(*by, "blk", "rep", "home", "v"),
                       by, edges, "a long, b long").distinct()
    comp = written(components(found), "vectors-components")

    def counts(g: dict) -> dict | None:
        i, j = linked(g, threshold)
        n, c = len(g["rep"]), g["copies"].astype(float)
        links = np.bincount(i, c[j], n) + np.bincount(j, c[i], n)
        return {"rep": g["rep"], "links": links.astype(np.int64)}

    inside = block_groups(reps.join(comp, reps["rep"] == comp["node"]).select("component", "dim", "rep", "copies", "v"),
                          ["component", "dim"], "rep")
    by2 = ["component", "dim", "bi", "bj"]
    links = map_groups(inside.select(*by2, "blk", "rep", "copies", "v"), by2, counts, "rep long, links long").groupBy(
        "rep").agg(F.sum("links").alias("links"))
    lowest = (comp.join(reps.select(F.col("rep").alias("node"), "low"), "node").groupBy("component")
              .agg(F.min("low").alias("least")))
    facts = (reps.select("v", "rep", "low", "copies").join(links, "rep", "left")
             .join(comp.join(lowest, "component").select(F.col("node").alias("rep"), "component", "least"), "rep", "left")
             .select("v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.when(F.col("component").isNull(), F.col("low")).otherwise(F.col("least")).alias("least")))
    return (whole.join(facts, "v", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("least")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op4_vectors(spark, sf_dir):
    return near_vectors(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
