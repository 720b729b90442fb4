"""SimHash near-dedup by covering locality-sensitive hashing.

A document's fingerprint has a bit set when the bit is set in over half of its shingles'
XXH64 values. Near pairs are found through ``2**(radius+1) - 1`` bit masks built from a
random map of bit positions to vectors over GF(2): for any set of at most ``radius``
differing bits some non-zero vector is orthogonal to all of theirs, so the two fingerprints
agree under that vector's mask. No pair within the radius is missed.

Defined results: null or blank text has fingerprint zero; texts with fewer words than a
shingle hash as one shingle; equal fingerprints always link; an empty table gives no rows;
repeated rows come back as often as they went in, a null doc_id links like any other but
never names a component while another member has an id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_groups, components, local_labels, map_groups, written

CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of one text."""
    ws = text.encode().lower().split() if text else []  # bytes: A-Z and the six blanks only
    if not ws:
        return 0
    norm = b" ".join(ws)
    xx = xxhash.xxh64_intdigest
    if len(ws) <= shingle:
        return xx(norm, 42)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    begin = np.concatenate(([0], ends[:-1] + 1))
    n = len(ws) - shingle + 1
    votes = np.zeros(64, np.int64)
    for lo in range(0, n, CHUNK):
        hi = min(n, lo + CHUNK)
        h = np.array([xx(norm[i:j], 42) for i, j in
                      zip(begin[lo:hi].tolist(), ends[lo + shingle - 1:hi + shingle - 1].tolist())], ">u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, keep: tuple = ()) -> DataFrame:
    """(doc_id, fp) and the long columns ``keep``: fingerprints as signed longs."""
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *[b.column(k) for k in keep]],
                                             ["doc_id", "fp", *keep])
    return docs.select(F.col("doc_id").cast("long"), "text", *keep).mapInArrow(
        run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *keep)))


def covering_masks(bits: int = 64, radius: int = 3, seed: int = 11) -> list[int]:
    """One mask per non-zero vector v of GF(2)^(radius+1): the positions i with <v, f(i)> = 1."""
    top = 1 << (radius + 1)
    f = np.random.default_rng(seed).permutation(np.resize(np.arange(1, top), bits)).tolist()
    return [sum(1 << i for i in range(bits) if (v & f[i]).bit_count() & 1) for v in range(1, top)]


def near_links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Star edges (a, b) between fingerprints at ``radius`` or fewer differing bits.

    ``fps`` has one row per distinct ``fp``. Within a block pair of a bucket all pairs are
    compared; what leaves a block is one edge per linked fingerprint to the first of its
    component in that block, so hot buckets don't multiply.
    """
    masks = [m - (1 << 64) if m >> 63 else m for m in covering_masks(radius=radius)]
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks]))
                       .alias("t", "k"))

    def compare(g: dict) -> dict | None:
        fp, blk = g["fp"].view(np.uint64), g["blk"]
        same = g["bi"][0] == g["bj"][0]
        left = np.arange(len(fp)) if same else np.flatnonzero(blk == g["bi"][0])
        right = left if same else np.flatnonzero(blk == g["bj"][0])
        i, j = [], []
        for lo in range(0, len(left), 256):
            part = left[lo:lo + 256]
            near = np.bitwise_count(fp[part][:, None] ^ fp[right][None, :]) <= radius
            x, y = np.nonzero(near)
            x, y = part[x], right[y]
            ok = x < y if same else slice(None)
            i.append(x[ok])
            j.append(y[ok])
        i, j = np.concatenate(i) if i else left, np.concatenate(j) if j else left
        if not len(i):
            return None
        lab = local_labels(len(fp), i, j)
        at = np.flatnonzero(lab != np.arange(len(fp)))
        return {"a": g["fp"][at], "b": g["fp"][lab[at]]}

    groups = block_groups(keyed, ["t", "k"], "fp")
    return map_groups(groups.select("t", "k", "bi", "bj", "blk", "fp"), ["t", "k", "bi", "bj"],
                      compare, "a long, b long")


def fingerprint_groups(fps: DataFrame, radius: int = 3) -> DataFrame:
    """(fp, rep, c): every distinct fingerprint, the smallest doc_id that has it and its group,
    named by a fingerprint."""
    reps = written(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-rep")
    comp = components(near_links(reps, radius))
    return reps.join(comp, reps["fp"] == comp["node"], "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("c"))


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id reachable over links of at most
    ``radius`` differing bits."""
    fps = written(fingerprints(docs, shingle), "simhash-fp")
    named = fingerprint_groups(fps, radius)
    first = named.groupBy("c").agg(F.min("rep").alias("component_id"))
    where = written(named.join(first, "c").select("fp", "component_id"), "simhash-component")
    return fps.join(where, "fp").select("doc_id", "fp", "component_id")


def op9_simhash(spark, sf_dir):
    from .common import documents
    return simhash_groups(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
