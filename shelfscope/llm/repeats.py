"""Suffix-array dedup: removes every byte covered by a ``window``-byte string that also
starts anywhere else in the corpus.

Documents are gathered into shards of about a megabyte (a longer document is a shard of its
own, worked through in blocks). Three facts keep the work in proportion to the input:

* Anchors. Each window selects the smallest hash among its ``gram``-byte substrings. Equal
  windows select the same anchor, so only windows whose anchor occurs twice in the corpus can
  repeat. Anchors are counted globally, about one for every 70 bytes.
* Inside a block, the text around anchors that occur twice there gets a suffix array by
  Larsson-Sadakane refinement (prefix doubling that re-sorts unsettled groups alone) and common
  prefixes by Kasai's bound; windows in a run of common prefixes of ``window`` bytes repeat.
* Across blocks, a stretch of consecutive windows with one anchor is a segment. Segments that
  are equal in two blocks repeat whole. Where segments with one anchor differ, each distinct
  segment is sent once, as its windows' 64-bit hashes in sorted runs; a merge task joins the
  runs of all shards for a range of hashes and finds by binary search what lies in two.

Texts are written once as a table bucketed by shard; later steps bring the small lists of
anchors and hits to it, so no text is shuffled.

The sorted runs are dealt and shuffled once, without being written; what is written are the
texts with their anchors, the anchors found twice, and the hits.

Defined results: null and empty texts have 0 bytes and the digest of nothing; texts shorter
than the window keep all; repeated rows repeat each other; ties (equal hashes in a window) go
to the first; a very long text is worked through in blocks; rows with a null doc_id are rows like
any others; columns beside doc_id and text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import documents, written

WINDOW = 200
GRAM = 64
SHARD = 1 << 20        # bytes gathered in a shard
BLOCK = 1 << 20        # window starts worked on at once
IDX = np.uint64(21)    # bits of a position in a block
MASK = np.uint64((1 << 21) - 1)
BASE = 0x9E3779B97F4A7C15 | 1
M64 = (1 << 64) - 1
TABLE = np.random.default_rng(97).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
MERGE = 1 << 20        # hashes a merge task holds
MOST_BUCKETS = 20_000  # of the table of texts; beyond 16 MB x this a bucket grows (Spark takes up to 100,000)

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK + 2 * WINDOW)
        inverse = pow(BASE, -1, 1 << 64)
        for k, b in enumerate((BASE, inverse)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[k:k + 1] = [np.cumprod(p, dtype=np.uint64)]
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    return h


class Block:
    """Windows that start in text[lo:hi], with their anchors and segments."""

    def __init__(self, text: np.ndarray, ends: np.ndarray, lo: int, hi: int, window: int, gram: int):
        self.lo, self.window = lo, window
        self.t = t = text[lo:min(len(text), hi + window - 1)]
        n = len(t)
        self.starts = np.zeros(0, np.int64)
        self.first = self.last = self.starts
        self.anchor = self.segment = np.zeros(0, np.uint64)
        if n < window:
            return
        p, self.inverse = powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(TABLE[t] * p[:n], out=self.sums[1:])
        # the end of the document that holds each start
        count = min(hi - lo, n - window + 1)
        e = np.concatenate(([0], ends))
        k = np.searchsorted(ends, np.array([lo, lo + count - 1]), side="right")
        cover = np.concatenate([np.full(max(0, min(ends[j], lo + count) - max(e[j], lo)), ends[j])
                                for j in range(k[0], min(k[1] + 1, len(ends)))])[:count]
        valid = np.arange(lo, lo + count) + window <= cover
        g = mix(self.hashes(np.arange(n - gram + 1), gram))
        low = (g & ~MASK) | np.arange(len(g), dtype=np.uint64)
        w = window - gram + 1
        pad = -len(low) % w
        q = np.concatenate([low, np.full(pad, M64, np.uint64)]).reshape(-1, w)
        ahead = np.minimum.accumulate(q, axis=1).ravel()
        behind = np.minimum.accumulate(q[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(behind[:count], ahead[w - 1:w - 1 + count]) & MASK).astype(np.int64)
        self.starts = s = np.flatnonzero(valid)
        if not len(s):
            return
        new = np.ones(len(s), bool)
        new[1:] = (at[s[1:]] != at[s[:-1]]) | (s[1:] != s[:-1] + 1)
        cut = np.flatnonzero(new)
        self.first, self.last = s[cut], s[np.append(cut[1:], len(s)) - 1]      # a segment's windows
        self.anchor = g[at[self.first]]
        size = (self.last - self.first + window).astype(np.uint64)
        place = (at[self.first] - self.first).astype(np.uint64)
        whole = (self.sums[self.last + window] - self.sums[self.first]) * self.inverse[self.first]
        self.segment = mix(whole + size * np.uint64(0x165667B19E3779F9) + place * np.uint64(0x27D4EB2F165667C5))

    def hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        """Polynomial hashes of the strings of ``size`` bytes."""
        return (self.sums[at + size] - self.sums[at]) * self.inverse[at]

    def ranges(self, pick: np.ndarray) -> np.ndarray:
        """The window starts of the picked segments."""
        return spread(self.first[pick], self.last[pick] + 1)


def spread(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    n = hi - lo
    if not len(n) or not n.sum():
        return np.zeros(0, np.int64)
    return np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())


# -- suffix array of one block's candidate text ------------------------------------------------

def suffix_array(t: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """(suffix array sorted to ``depth`` characters or more, first place of each entry's
    unsettled group, characters that the last round compared, entries joined to the one before
    when that round began). Larsson-Sadakane: each round sorts the groups that are still open by
    the ranks ``h`` characters further on."""
    n = len(t)
    wide = np.concatenate([t, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(5):
        key = (key << np.uint64(8)) | wide[k:k + n]
    key = (key << IDX) | np.arange(n, dtype=np.uint64)
    key.sort()
    sa = (key & MASK).astype(np.int64)
    key >>= IDX
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[sa] = head + 1
    rank[n] = 0
    h, joined = 5, ~new
    while h < depth:
        joined = np.zeros(n, bool)
        joined[1:] = head[1:] == head[:-1]
        open_ = joined.copy()
        open_[:-1] |= joined[1:]
        u = np.flatnonzero(open_)
        if not len(u):
            break
        i = sa[u]
        key = ((head[u].astype(np.uint64) << (IDX + IDX)) | (rank[np.minimum(i + h, n)].astype(np.uint64) << IDX)
               | i.astype(np.uint64))
        key.sort()
        sa[u] = (key & MASK).astype(np.int64)
        key >>= IDX
        first = np.ones(len(u), bool)
        first[1:] = key[1:] != key[:-1]
        head[u] = u[np.maximum.accumulate(np.where(first, np.arange(len(u)), 0))]
        rank[sa[u]] = head[u] + 1
        h *= 2
    return sa, head, h, joined


def common_prefixes(t: np.ndarray, at: np.ndarray, before: np.ndarray, known: int, cap: int) -> np.ndarray:
    """Common prefix, up to ``cap``, of the suffixes ``at`` (ascending) and the suffixes that
    stand before them in the array, by Kasai's bound: a suffix shares at least one character
    less with its predecessor than the suffix that starts one earlier. Whole strides of
    suffixes are extended at once, each from the bound left by the coarser stride. The pairs
    must be in strict order: suffixes that tie at the sorted depth have no bound to give."""
    n = len(t)
    wide = np.concatenate([t, np.zeros(cap + 16, np.uint8)]).astype(np.uint64)
    word = np.zeros(n + cap + 8, np.uint64)
    for k in range(8):
        word |= wide[k:k + len(word)] << np.uint64(8 * k)
    plcp = np.full(n, -1, np.int64)
    done = np.zeros(len(at), bool)
    for stride in (64, 16, 4, 1):
        pick = np.flatnonzero(~done & (at % stride == 0))
        if not len(pick):
            continue
        done[pick] = True
        i, j = at[pick], before[pick]
        back = np.maximum(i - np.where(stride == 1, 1, stride), 0)
        size = np.minimum(np.maximum(known, plcp[back] - (i - back)), cap)
        live = np.flatnonzero(size < cap)
        while len(live):
            x = word[i[live] + size[live]] ^ word[j[live] + size[live]]
            same = x == 0
            low = x & (~x + np.uint64(1))
            step = np.where(same, 8, (np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)) // 8)).astype(np.int64)
            size[live] += step
            live = live[same & (size[live] < cap)]
        plcp[i] = np.minimum(size, cap)
    return plcp[at]


def repeated_inside(b: Block) -> np.ndarray:
    """Window starts of the block whose string starts twice in it."""
    order = np.argsort(b.anchor, kind="stable")
    a = b.anchor[order]
    twice = np.zeros(len(a), bool)
    if len(a) > 1:
        same = a[1:] == a[:-1]
        twice[1:] |= same
        twice[:-1] |= same
    pick = np.sort(order[twice])
    if not len(pick):
        return np.zeros(0, np.int64)
    lo, hi = b.first[pick], b.last[pick] + b.window
    gap = np.ones(len(lo), bool)
    gap[1:] = lo[1:] > np.maximum.accumulate(hi)[:-1]
    at = np.flatnonzero(gap)
    lo, hi = lo[at], np.maximum.reduceat(hi, at)
    source = spread(lo, hi)                            # place in the block of each candidate byte
    t = b.t[source]
    valid = np.zeros(len(b.t) + 1, bool)
    valid[b.ranges(pick)] = True
    valid = valid[source]
    sa, head, h, joined = suffix_array(t, b.window)
    near = np.zeros(len(sa), bool)                     # common prefix with the entry before >= window
    near[1:] = head[1:] == head[:-1]
    if h < b.window:                                   # all settled before
        near[:] = False
    ask = np.flatnonzero(joined & ~near)               # parted in the last round: at least h / 2 in common
    if len(ask):
        ask = ask[np.argsort(sa[ask])]
        size = common_prefixes(t, sa[ask], sa[ask - 1], h // 2 if h > 5 else 0, b.window)
        near[ask[size >= b.window]] = True
    group = np.cumsum(~near) - 1
    ok = valid[sa]
    return source[sa[ok & (np.bincount(group, ok)[group] >= 2)]]


# -- jobs ------------------------------------------------------------------------------------

SHARDS = ("shard long, block int, ids array<long>, sizes array<long>, body binary, "
          "anchors array<long>, segments array<long>")


def blocks(text: np.ndarray, ends: np.ndarray, window: int, gram: int):
    for k, lo in enumerate(range(0, max(1, len(text)), BLOCK)):
        yield k, Block(text, ends, lo, lo + BLOCK, window, gram)


def gather(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def rows(ids, bodies, shard):
        body = b"".join(bodies)
        sizes = [len(x) for x in bodies]
        text, ends = np.frombuffer(body, np.uint8), np.cumsum(sizes, dtype=np.int64)
        for k, b in blocks(text, ends, window, gram):
            pair = np.unique(np.stack([b.anchor, b.segment], axis=1), axis=0) if len(b.anchor) else np.zeros((0, 2), np.uint64)
            yield pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int64()), pa.array([k], pa.int32()), pa.array([ids if not k else []], pa.list_(pa.int64())),
                pa.array([sizes if not k else []], pa.list_(pa.int64())), pa.array([body if not k else None], pa.binary()),
                pa.array([pair[:, 0].copy().view(np.int64)], pa.list_(pa.int64())),
                pa.array([pair[:, 1].copy().view(np.int64)], pa.list_(pa.int64()))],
                ["shard", "block", "ids", "sizes", "body", "anchors", "segments"])

    def run(batches):
        shard, ids, bodies, size = TaskContext.get().partitionId() << 32, [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                x = t.as_py()
                x = x.encode() if x else b""
                if ids and size + len(x) > SHARD:
                    yield from rows(ids, bodies, shard)
                    shard, ids, bodies, size = shard + 1, [], [], 0
                ids.append(i)
                bodies.append(x)
                size += len(x)
        if ids:
            yield from rows(ids, bodies, shard)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SHARDS)


def bucketed(df: DataFrame, by: str, parts: int) -> DataFrame:
    """``df`` written to the shared folder as a table bucketed by ``by``: joins on it move the
    other side only."""
    spark = df.sparkSession
    name = f"shards_{uuid.uuid4().hex}"
    (df.write.format("parquet").option("compression", "zstd").option("path", f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}")
     .bucketBy(parts, by).sortBy(by).saveAsTable(name))
    return spark.table(name)


def pieces_of(row: dict, window: int, gram: int):
    text = np.frombuffer(row["body"], np.uint8)
    return text, np.cumsum(row["sizes"], dtype=np.int64)


def look(shards: DataFrame, orders: DataFrame, window: int, gram: int, parts: int) -> DataFrame:
    """Second pass over the texts: windows known to repeat as (shard, hits), and for each of
    ``parts`` ranges of hashes the shard's sorted run to merge, as (part, shard, hashes, places)."""
    edge = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                if row["body"] is None:
                    continue
                text, ends = pieces_of(row, window, gram)
                key = np.array(row["keys"] or [], np.int64).view(np.uint64)
                act = np.array(row["acts"] or [], np.int64)
                by = np.argsort(key)
                key, act = key[by], act[by]
                hits, fps, places = [], [], []
                for k, blk in blocks(text, ends, window, gram):
                    if not len(blk.anchor):
                        continue
                    hits.append(repeated_inside(blk) + blk.lo)
                    own = mix(blk.anchor + np.uint64(k) * np.uint64(BASE)) ^ blk.segment
                    at = np.searchsorted(key, own)
                    at[at == len(key)] = 0
                    do = np.where(key[at] == own, act[at], 0) if len(key) else np.zeros(len(own), int)
                    hits.append(blk.ranges(np.flatnonzero(do & 1)) + blk.lo)
                    once = np.unique(own, return_index=True)[1]
                    s = blk.ranges(np.sort(once[(do[once] & 2) > 0]))
                    fps.append(mix(blk.hashes(s, window) if len(s) else np.zeros(0, np.uint64)))
                    places.append(s + blk.lo)
                hit = np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.int64)
                fp = np.concatenate(fps) if fps else np.zeros(0, np.uint64)
                order = np.argsort(fp, kind="stable")
                place = np.concatenate(places)[order] if fps else np.zeros(0, np.int64)
                fp, place, shard = fp[order], place.astype(np.uint32), row["shard"]
                cut = np.concatenate(([0], np.searchsorted(fp, edge), [len(fp)]))
                live = np.flatnonzero(cut[1:] > cut[:-1])
                for some in np.split(live, range(10_000, len(live), 10_000)) if len(live) else ():
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array(some.astype(np.int32)), "shard": pa.array(np.full(len(some), shard)),
                        "hashes": pa.array([fp[cut[k]:cut[k + 1]].tobytes() for k in some], pa.binary()),
                        "places": pa.array([place[cut[k]:cut[k + 1]].tobytes() for k in some], pa.binary()),
                        "hits": pa.nulls(len(some), pa.binary())})
                if len(hit):
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array([shard % parts], pa.int32()), "shard": pa.array([shard], pa.int64()),
                        "hashes": pa.nulls(1, pa.binary()), "places": pa.nulls(1, pa.binary()), "hits": pa.array([runs(hit)], pa.binary())})
    d = shards.where("block = 0").select("shard", "sizes", "body").join(orders, "shard", "left")
    return d.select("shard", "sizes", "body", "keys", "acts").mapInArrow(
        run, "part int, shard long, hashes binary, places binary, hits binary")


def runs(s: np.ndarray) -> bytes:
    """Ascending numbers as (first, end) of their runs."""
    if not len(s):
        return b""
    cut = np.flatnonzero(np.diff(s) != 1)
    return np.stack([s[np.append(0, cut + 1)], s[np.append(cut, len(s) - 1)] + 1], axis=1).astype(np.int64).tobytes()


def merged(found: DataFrame, parts: int) -> DataFrame:
    """(shard, hits): the hits known already, and places whose hash is in the runs of two shards
    (or twice in one). A task takes its ranges of hashes one after another."""
    def join(batches):
        part, held = None, []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if row[4] is not None:
                    yield pa.RecordBatch.from_pydict({"shard": pa.array([row[1]], pa.int64()), "hits": pa.array([row[4]], pa.binary())})
                    continue
                if row[0] != part and held:
                    yield from common(held)
                    held = []
                part = row[0]
                held.append(row)
        if held:
            yield from common(held)

    def common(held):
        lists = [np.frombuffer(r[2], np.uint64) for r in held]
        every = np.concatenate(lists)
        every.sort(kind="stable")
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        for r, h in zip(held, lists):
            at = np.searchsorted(twice, h)
            at[at == len(twice)] = 0
            ok = twice[at] == h if len(twice) else np.zeros(len(h), bool)
            if ok.any():
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([r[1]], pa.int64()),
                    "hits": pa.array([runs(np.sort(np.frombuffer(r[3], np.uint32)[ok].astype(np.int64)))], pa.binary())})

    return found.repartition(min(parts, MOST_BUCKETS), "part").sortWithinPartitions("part").mapInArrow(join, "shard long, hits binary")


def remove(shards: DataFrame, hits: DataFrame, window: int, with_text: bool) -> DataFrame:
    """Per document: bytes, removed bytes, removed runs, digest of what is left (and that text)."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                body = row["body"]
                text, ends = np.frombuffer(body, np.uint8), np.cumsum(row["sizes"], dtype=np.int64)
                edge = np.zeros(len(text) + 1, np.int32)
                for h in row["hits"] or []:
                    r = np.frombuffer(h, np.int64).reshape(-1, 2)
                    np.add.at(edge, r[:, 0], 1)
                    np.add.at(edge, r[:, 1] - 1 + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                out = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
                for i, lo, hi in zip(row["ids"], np.append(0, ends[:-1]).tolist(), ends.tolist()):
                    g = gone[lo:hi]
                    kept = text[lo:hi][~g].tobytes()
                    out["doc_id"].append(i)
                    out["n_bytes"].append(hi - lo)
                    out["n_removed"].append(int(g.sum()))
                    out["n_spans"].append(int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()))
                    out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    out["kept"].append(kept if with_text else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["doc_id"], pa.int64()), *(pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")),
                     pa.array(out["kept_sha256"], pa.string()), pa.array(out["kept"], pa.binary())], list(out))
    d = shards.where("block = 0").select("shard", "ids", "sizes", "body").join(
        hits.groupBy("shard").agg(F.collect_list("hits").alias("hits")), "shard", "left")
    return d.select("ids", "sizes", "body", "hits").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): ``kept`` is what is left, as
    bytes (null unless ``with_text``; a cut may fall inside a character)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = bucketed(gather(docs, window, gram), "shard", min(MOST_BUCKETS, max(4, int(size >> 24))))
    # a place is a shard and its block (a text has fewer than 2 ** 31 bytes, so fewer than 2 ** 12 blocks)
    one = (shards.select((F.col("shard") * 4096 + F.col("block")).alias("place"), F.explode(F.arrays_zip("anchors", "segments")).alias("a"))
           .select("place", F.col("a.anchors").alias("anchor"), F.col("a.segments").alias("segment")))
    place = F.col("place")
    shared = one.groupBy("anchor").agg(F.min(place).alias("p"), F.max(place).alias("q"),
                                       F.min("segment").alias("s"), F.max("segment").alias("t"))
    shared = shared.where("p != q").select("anchor", (F.col("s") != F.col("t")).alias("differ"))
    met = written(one.join(shared, "anchor"), "repeats-anchors")
    same = met.where("differ").groupBy(F.col("anchor").alias("_a"), F.col("segment").alias("_s")).agg(
        F.min(place).alias("owner"), F.count("*").alias("places"))
    told = met.where("differ").join(same, (F.col("anchor") == F.col("_a")) & (F.col("segment") == F.col("_s"))).select(
        "place", "anchor", "segment",
        ((F.col("places") > 1).cast("long") + 2 * (F.col("owner") == place).cast("long")).alias("act"))
    told = told.where("act > 0").unionByName(met.where("not differ").select(
        "place", "anchor", "segment", F.lit(1).cast("long").alias("act")))

    def keyed(batches):
        for b in batches:
            at, anchor, segment = (b.column(k).to_numpy() for k in (0, 1, 2))
            own = mix(anchor.view(np.uint64) + (at % 4096).astype(np.uint64) * np.uint64(BASE)) ^ segment.view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(at // 4096), pa.array(own.view(np.int64)), b.column(3)], ["shard", "key", "act"])
    told = written(told.mapInArrow(keyed, "shard long, key long, act long"), "repeats-told")
    orders = told.groupBy("shard").agg(F.collect_list(F.struct("key", "act")).alias("o")).select(
        "shard", F.col("o.key").alias("keys"), F.col("o.act").alias("acts"))
    # a segment has at most window - gram + 1 windows; the hashes are only shuffled, never written
    parts = told.where("act >= 2").count() * (window - gram + 1) // MERGE + 1
    hits = written(merged(look(shards, orders, window, gram, parts), parts), "repeats-hits")
    return remove(shards, hits, window, with_text)


def op3_repeats(spark, sf_dir):
    return remove_repeats(documents(spark, sf_dir), with_text=False).drop("kept")
