"""Packing into fixed-length sequences by cutting-stock column generation.

A document's ids are cut into full sequences and one remainder. Remainders fall into length
classes of ``unit`` tokens; the histogram of classes is the demand of a cutting-stock linear
program whose columns are patterns (how many pieces of each class share a sequence). New
columns are priced by knapsack dynamic programming over the duals until none improves. The
solution is rounded down, the small rest is packed first-fit decreasing, and the pieces,
ranked within their class, are dealt to the patterns' instances.

The program has at most ``length / unit`` rows whatever the corpus size and is all that the
driver solves. Ranking is distributed: rank = rows in earlier hash buckets of the class +
place in the bucket.

Tokenizing: each text is encoded whole, in one call, straight to the bytes of its ids; what it
costs depends on the text's length alone, not on how often its words come again.

Defined results: null text counts as empty; an empty text has the end id alone; repeated
rows are packed as often as they come; an empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, written

LENGTH = 2048
END_ID = 1


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# -- tokens ---------------------------------------------------------------------------------

@lru_cache(2)
def tokenizer(path: str):
    """Encoder of whole texts to id bytes, for a byte-level BPE in the tokenizers' JSON format."""
    import public_tokenizers
    import tiktoken
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    other = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
    bpe = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> bytes:
        return bpe.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()

    return encode


def pieces(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): full sequences and the remainder."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        encode = tokenizer(path)
        for b in batches:
            at, start, size, crc, total = [], [], [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                ids = encode(t or "") + end
                n = len(ids) // 4
                for lo in range(0, n, length):
                    at.append(i)
                    start.append(lo)
                    size.append(min(length, n - lo))
                    crc.append(zlib.crc32(ids[4 * lo:4 * (lo + length)]))
                    total.append(n)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0).take(pa.array(at, pa.int64())), "start": pa.array(start, pa.int64()),
                "length": pa.array(size, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": pa.array(total, pa.int64())})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


# -- cutting stock --------------------------------------------------------------------------

def best_pattern(value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: item c (1-based) weighs c and is worth
    value[c]. Returns the best worth and the counts."""
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, int)
    for room in range(1, capacity + 1):
        worth = best[room - 1::-1][:room] + value[1:room + 1]
        c = int(worth.argmax())
        if worth[c] > best[room - 1] + 1e-12:
            best[room], choice[room] = worth[c], c + 1
        else:
            best[room] = best[room - 1]
    counts, room = np.zeros(capacity + 1, int), capacity
    while room > 0:
        if choice[room]:
            counts[choice[room]] += 1
            room -= choice[room]
        else:
            room -= 1
    return best[capacity], counts


def invert(a: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination. The program is small; plain numpy keeps it on one thread
    beside the JVM."""
    m = len(a)
    w = np.hstack([a, np.eye(m)])
    for k in range(m):
        p = k + int(np.abs(w[k:, k]).argmax())
        if p != k:
            w[[k, p]] = w[[p, k]]
        w[k] /= w[k, k]
        f = w[:, k].copy()
        f[k] = 0
        w -= f[:, None] * w[k]
    return w[:, m:]


def solve(demand: np.ndarray, gap: float = 5e-4, max_rounds: int = 20_000) -> list[tuple[int, dict[int, int]]]:
    """Patterns (number of sequences, {class: pieces}) that hold ``demand[c]`` pieces of
    class c = 1..capacity, a class weighing c of the capacity.

    Columns are added until the best new one is worth at most 1 + ``gap``: the program's value
    is then within that factor of the optimum (Farley's bound)."""
    capacity = len(demand) - 1
    live = [c for c in range(1, capacity + 1) if demand[c] > 0]
    if not live:
        return []
    m = len(live)
    need = demand[live].astype(float)
    place = {c: k for k, c in enumerate(live)}
    columns: list = [{c: capacity // c} for c in live]  # of the basis: patterns, or rows with a surplus
    inverse = np.diag([1.0 / (capacity // c) for c in live])
    cost = np.ones(m)
    times = lambda a, v: (a * v).sum(axis=1)
    x = times(inverse, need)
    for k in range(max_rounds):
        dual = (cost[:, None] * inverse).sum(axis=0)
        low = int(dual.argmin())
        if dual[low] < -1e-9:                         # a surplus column improves
            enter, price, pattern = -(np.arange(m) == low).astype(float), 0.0, low
        else:
            value = np.zeros(capacity + 1)
            value[live] = dual
            worth, counts = best_pattern(value, capacity)
            if worth <= 1 + gap:
                break
            enter, price = counts[live].astype(float), 1.0
            pattern = {c: int(counts[c]) for c in live if counts[c]}
        d = times(inverse, enter)
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        row = inverse[out] / d[out]
        inverse -= d[:, None] * row
        inverse[out] = row
        columns[out], cost[out] = pattern, price
        if k % 500 == 499:                            # against rounding errors
            basis = np.zeros((m, m))
            for j, p in enumerate(columns):
                if isinstance(p, dict):
                    basis[[place[c] for c in p], j] = list(p.values())
                else:
                    basis[p, j] = -1
            inverse = invert(basis)
        x = np.maximum(times(inverse, need), 0)
    left, plan = demand.astype(int).copy(), []
    for n, p in sorted(((int(v + 1e-6), p) for v, p in zip(x, columns) if isinstance(p, dict)),
                       key=lambda t: -t[0]):
        n = min([n, *(left[c] // a for c, a in p.items())])
        if n > 0:
            plan.append((n, p))
            for c, a in p.items():
                left[c] -= n * a
    bins: list[tuple[int, dict[int, int]]] = []
    for c in range(capacity, 0, -1):                  # what rounding left: first fit decreasing
        for i, (room, p) in enumerate(bins):
            if left[c] and room >= c:
                a = min(int(left[c]), room // c)
                p[c] = p.get(c, 0) + a
                bins[i] = (room - a * c, p)
                left[c] -= a
        while left[c]:
            a = min(int(left[c]), capacity // c)
            bins.append((capacity - a * c, {c: a}))
            left[c] -= a
    return plan + [(1, p) for _, p in bins]


# -- assignment -----------------------------------------------------------------------------

def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, unit: int = 8,
         bucket_rows: int = 4096) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    cut = written(pieces(docs, path or default_tokenizer(), length)
                  .withColumn("cls", F.ceil(F.col("length") / unit).cast("int")), "pack-pieces")
    hist = cut.groupBy("cls").count().collect()       # at most length / unit rows
    demand = np.zeros(length // unit + 1, np.int64)
    for r in hist:
        demand[r["cls"]] = r["count"]
    rows, base, filled = [], 0, {}
    for p, (n, pattern) in enumerate(solve(demand)):
        slot = 0
        for c in sorted(pattern, reverse=True):
            a, lo = pattern[c], filled.get(c, 0)
            rows.append((c, lo, lo + n * a, a, base, slot))
            filled[c] = lo + n * a
            slot += a
        base += n
    plan = spark.createDataFrame(
        rows, "cls int, lo long, hi long, per int, base long, slot int")  # bounded by the classes
    buckets = max(1, int(demand.sum()) // bucket_rows)
    d = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    before = d.groupBy("cls", "bucket").count().withColumn("before", F.coalesce(F.sum("count").over(
        Window.partitionBy("cls").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    own = Window.partitionBy("cls", "bucket").orderBy("doc_id", "start", "ids_crc32")
    d = d.withColumn("n", F.row_number().over(own) - 1).join(before, ["cls", "bucket"])
    d = d.withColumn("rank", F.col("before") + F.col("n")).join(
        F.broadcast(plan), (d["cls"] == plan["cls"]) & (F.col("rank") >= plan["lo"]) & (F.col("rank") < plan["hi"]))
    d = (d.withColumn("sequence_id", F.col("base") + F.floor((F.col("rank") - F.col("lo")) / F.col("per")))
         .withColumn("place", F.col("slot") + (F.col("rank") - F.col("lo")) % F.col("per")))
    here = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return d.withColumn("offset", F.coalesce(F.sum("length").over(here), F.lit(0))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir))
