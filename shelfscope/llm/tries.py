"""Conversation prefix trie: adaptive radix trees over fixed-width turn ids.

A turn's id is the first 16 bytes of the SHA-256 of its role and text, so a conversation is a
byte string of fixed-width big-endian ids and byte order is depth-first order. All strings are
range-partitioned and sorted; a task runs through its range in blocks and puts each block's
distinct strings into an adaptive radix tree (nodes of 4, 16, 48 and 256 children that grow,
with compressed paths). Only depths that are a multiple of the id's width are nodes of the trie;
a compressed path may hold many, and none of the bytes between.

Nodes on the way to a block's first string may lie in the block before, too. All a node's figures
are sums (or least values) over blocks once what two neighbours both count is taken back, and
that is known from one's last and the other's first string alone. So a range holds no node
whole, and a node over a third of all conversations is a few rows, one per block.

A conversation longer than ``SEGMENT`` turns is cut; each later segment is a string of its own
under the hash of all turns ahead of it, and its totals are brought to the nodes above by
pointer doubling over the segments. The ids of equal conversations run through SHA-256 in
ascending order, as a stream of pieces where a task's range ends within them.

Defined results: turns of one conversation are ordered by turn, null first, then role, then the
id; null role or text counts as empty; rows without a conversation id belong to none and are
left out; a conversation without turns ends in the root; repeated rows are turns of their own; texts
of any length count by their bytes and travel no further than their id; an empty table has no nodes; columns
other than the four named are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import rank_within_groups
from .common import written

ID = 16
SEGMENT = 256
ROOT = bytes(ID)
BLOCK_BYTES = 4 << 20    # distinct strings of one tree
PIECE = 1 << 16          # bytes of conversation ids in one row


# -- the adaptive radix tree ----------------------------------------------------------------

class Few:
    """Up to 4, then up to 16 children: sorted bytes beside their children."""

    __slots__ = ("room", "bytes", "kids")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.kids = room, bytearray(), []

    def find(self, b: int):
        i = self.bytes.find(b)
        return self.kids[i] if i >= 0 else None

    def add(self, b: int, child):
        if len(self.bytes) == self.room:
            if self.room == 4:
                self.room = 16
            else:
                return Indexed(zip(self.bytes, self.kids)).add(b, child)
        i = next((i for i, x in enumerate(self.bytes) if x > b), len(self.bytes))
        self.bytes.insert(i, b)
        self.kids.insert(i, child)
        return self

    def children(self):
        return zip(self.bytes, self.kids)


class Indexed:
    """Up to 48 children, found by an index of 256 bytes."""

    __slots__ = ("index", "kids")

    def __init__(self, items):
        self.index, self.kids = bytearray(256), []
        for b, child in items:
            self.kids.append(child)
            self.index[b] = len(self.kids)

    def find(self, b: int):
        i = self.index[b]
        return self.kids[i - 1] if i else None

    def add(self, b: int, child):
        if len(self.kids) == 48:
            return Full(self.children()).add(b, child)
        self.kids.append(child)
        self.index[b] = len(self.kids)
        return self

    def children(self):
        return ((b, self.kids[i - 1]) for b, i in enumerate(self.index) if i)


class Full:
    """One slot for every byte."""

    __slots__ = ("kids",)

    def __init__(self, items):
        self.kids = [None] * 256
        for b, child in items:
            self.kids[b] = child

    def find(self, b: int):
        return self.kids[b]

    def add(self, b: int, child):
        self.kids[b] = child
        return self

    def children(self):
        return ((b, x) for b, x in enumerate(self.kids) if x is not None)


class Node:
    """``path`` is the compressed path behind the byte that leads here; ``value`` what ends here."""

    __slots__ = ("path", "layout", "value")

    def __init__(self, path: bytes, value=None, layout=None):
        self.path, self.value, self.layout = path, value, layout or Few()


def insert(node: Node, key: bytes, value) -> None:
    i = 0
    while True:
        path, m = node.path, 0
        if key.startswith(path, i):
            m = len(path)
        else:
            while m < len(path) and i + m < len(key) and key[i + m] == path[m]:
                m += 1
            low = Node(path[m + 1:], node.value, node.layout)
            node.path, node.value, node.layout = path[:m], None, Few().add(path[m], low)
        i += m
        if i == len(key):
            node.value = value
            return
        child = node.layout.find(key[i])
        if child is None:
            node.layout = node.layout.add(key[i], Node(key[i + 1:], value))
            return
        node, i = child, i + 1


class Total:
    """What a subtree sums up to: strings below, least conversation, nodes one level below the
    next node above, childless nodes, saved bytes; and a text length list and level of any string."""

    __slots__ = ("n", "conv", "kids", "leaves", "saved", "lens", "base")

    def __init__(self):
        self.n = self.kids = self.leaves = self.saved = self.base = 0
        self.conv = self.lens = None

    def add(self, o) -> None:
        self.n += o.n
        self.kids += o.kids
        self.leaves += o.leaves
        self.saved += o.saved
        self.conv = o.conv if self.conv is None else self.conv if o.conv is None else min(self.conv, o.conv)
        self.lens, self.base = o.lens, o.base


def node_id(prefix: bytes) -> bytes:
    """The id of the node behind a context and the turn ids after it."""
    return prefix if len(prefix) == ID else hashlib.sha256(prefix).digest()[:ID]


def emit(tree: Node):
    """(node, parent, depth, top, n, conv, kids, leaves, saved) of every turn-aligned depth of a
    tree, children first. ``top`` marks a later segment's context, whose own figures the
    segment before it has."""
    path = bytearray(tree.path)
    stack = [(tree, 0, Total(), tree.layout.children())]
    while stack:
        node, start, total, rest = stack[-1]
        nxt = next(rest, None)
        if nxt is not None:
            b, child = nxt
            above = len(path)
            path.append(b)
            path += child.path
            stack.append((child, above, Total(), child.layout.children()))
            continue
        stack.pop()
        end = len(path)
        if node.value is not None:
            n, conv, _, lens, base = node.value
            total.n += n
            total.conv = conv if total.conv is None else min(total.conv, conv)
            total.lens, total.base = lens, base
        for e in range(end - end % ID, start, -ID):
            here, depth = bytes(path[:e]), e // ID - 1
            if total.kids == 0 and node.value[2]:
                total.leaves += 1
            if depth:
                total.saved += (total.n - 1) * total.lens[depth - 1]
                yield (node_id(here), node_id(here[:-ID]), total.base + depth, False, total.n, total.conv,
                       total.kids, total.leaves, total.saved)
            elif here == ROOT:
                yield ROOT, None, 0, False, total.n, total.conv, total.kids, total.leaves, total.saved
            else:
                yield here, None, None, True, 0, None, total.kids, total.leaves, total.saved
            total.kids = 1
        del path[start:]
        if stack:
            stack[-1][2].add(total)


# -- blocks and their seams -----------------------------------------------------------------

def seam(last: bytes, last_leaf: bool, first: bytes, lens: list[int], first_leaf: bool):
    """What two neighbouring blocks both count, taken back: rows as of ``emit``."""
    shared = 0
    while shared < min(len(last), len(first)) and last[shared:shared + ID] == first[shared:shared + ID]:
        shared += ID
    deepest = shared // ID - 1
    leaf = 0
    if shared == len(last):
        leaf = int(last_leaf or first_leaf) if last == first else int(last_leaf)
    saved = 0
    for d in range(deepest, -1, -1):
        saved += lens[d - 1] if d else 0
        here = first[:(d + 1) * ID]
        yield (node_id(here), None, None, d == 0 and here != ROOT, 0, None, -1 if d < deepest else 0, -leaf, saved)


NODES = "node binary, parent binary, depth long, top boolean, n long, conv long, kids long, leaves long, saved long"
PARTS = (f"kind int, {NODES}, ends string, pid int, seq long, text binary, first binary, lens array<int>, "
         "leaf boolean, last binary, last_leaf boolean")
NAMES = [f.split()[0] for f in PARTS.split(", ")]
TYPES = pa.schema([
    ("kind", pa.int32()), ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("top", pa.bool_()),
    ("n", pa.int64()), ("conv", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()),
    ("ends", pa.string()), ("pid", pa.int32()), ("seq", pa.int64()), ("text", pa.binary()), ("first", pa.binary()),
    ("lens", pa.list_(pa.int32())), ("leaf", pa.bool_()), ("last", pa.binary()), ("last_leaf", pa.bool_())])
NODE, ENDS, SEAM = 0, 1, 2


def batches_of(rows, schema: pa.Schema, size: int = 5_000, heavy: int = 4 << 20):
    """Rows (tuples or dicts) as record batches, cut by rows and by the bytes of their texts."""
    out, held = [], 0
    for r in rows:
        out.append(r if isinstance(r, dict) else dict(zip(schema.names, r)))
        held += len(out[-1].get("text") or b"")
        if len(out) == size or held > heavy:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


class Run:
    """The rows of one string: its members, and those that end there as a hash or as pieces."""

    def __init__(self, key: bytes, lens, base: int):
        self.key, self.lens, self.base = key, lens, base
        self.n, self.conv, self.open = 0, None, False
        self.sha, self.text, self.ended, self.pieces = hashlib.sha256(), bytearray(), 0, 0

    def add(self, conv: int, fin: bool) -> None:
        self.n += 1
        self.conv = conv if self.conv is None else min(self.conv, conv)
        if not fin:
            self.open = True           # goes on in a later segment
            return
        part = b"%d" % conv
        self.sha.update(part if not self.ended else b"," + part)
        self.text += part if not self.text else b"," + part
        self.ended += 1

    def piece(self, pid: int) -> dict:
        row = {"kind": ENDS, "node": node_id(self.key), "pid": pid, "seq": self.pieces, "text": bytes(self.text)}
        self.pieces += 1
        self.text = bytearray()
        return row


def blocks(rows, pid: int, block_bytes: int = BLOCK_BYTES, piece: int = PIECE):
    """Part rows of a task's sorted range of (string, fin, conv, base, lens)."""
    tree, held, strings = None, 0, 0
    first = run = head = None          # first run of the range; the current one; first of its block
    last = second = None               # last string of the block before; second string of the range's first block

    def close(at_edge: bool):
        """The finished run: into the tree, its ends as a hash, or as pieces where others may follow."""
        nonlocal tree, held, head, strings, second
        if tree is None:
            tree, head, strings = Node(b""), run, 0
        insert(tree, run.key, (run.n, run.conv, not run.open, run.lens, run.base))
        held += len(run.key) + 200
        strings += 1
        if strings == 2 and head is first:
            second = run.key
        if run.ended:
            if not at_edge and not run.pieces:
                yield {"kind": NODE, "node": node_id(run.key), "ends": run.sha.hexdigest()}
            elif run.text:
                yield run.piece(pid)

    def finish():
        """The block's tree, and its seam with the block before."""
        nonlocal tree, held, last
        yield from ((NODE, *r) for r in emit(tree))
        if last is not None:
            yield from ((NODE, *r) for r in seam(last, last_leaf, head.key, head.lens, False))
        tree, held, last = None, 0, run.key

    last_leaf = False
    for key, fin, conv, base, lens in rows:
        if run is None or key != run.key:
            if run is not None:
                yield from close(run is first)
                if held > block_bytes:
                    yield from finish()
                    last_leaf = not run.open
            run = Run(key, lens, base)
            first = first or run
        run.add(conv, fin)
        if len(run.text) > piece:
            yield run.piece(pid)
    if run is not None:
        yield from close(True)
        yield from finish()
        yield {"kind": SEAM, "pid": pid, "first": first.key, "lens": first.lens, "last": run.key, "last_leaf": not run.open,
               "leaf": not first.open and not (second is not None and second.startswith(first.key))}


# -- the operator -------------------------------------------------------------------------------

def ordered(conversations: DataFrame) -> DataFrame:
    """(c, pos, id, bytes): every conversation's turns, counted from 1."""
    role, text = (F.coalesce(F.col(k).cast("string"), F.lit("")) for k in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("t"), role.alias("r"),
        F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)), 1, ID)
        .alias("id"), F.octet_length(text).alias("bytes"))
    return rank_within_groups(turns, ["c"], [F.col("t").asc_nulls_first(), "r", "id"], "pos").select("c", "pos", "id", "bytes")


def strings(turns: DataFrame, sizes: DataFrame, segment: int) -> DataFrame:
    """(c, m, seg, key, lens): the conversations' segments of up to ``segment`` turns. ``turns``
    has (c, m, p, id, bytes), ``sizes`` (c, m) of all conversations, those without turns too."""
    segs = (turns.groupBy("c", "m", F.expr(f"(p - 1) div {segment}").alias("seg"))
            .agg(F.sort_array(F.collect_list(F.struct("p", "id", "bytes"))).alias("e"))
            .select("c", "m", "seg", F.unhex(F.array_join(F.transform("e", lambda x: F.hex(x["id"])), "")).alias("key"),
                    F.transform("e", lambda x: x["bytes"]).alias("lens")))
    none = sizes.where("m = 0").select("c", "m", F.lit(0).cast("long").alias("seg"), F.lit(b"").alias("key"),
                                       F.array().cast("array<int>").alias("lens"))
    return written(segs.unionByName(none), "trie-segments")


def chained(long: DataFrame, segment: int) -> DataFrame:
    """Segments of long conversations under the hash of the turns ahead of them."""
    def run(batches):
        conv, ctx = None, ROOT
        for b in batches:
            c, m, seg, key, lens = (b.column(i).to_pylist() for i in range(5))
            full, fin, base = [], [], []
            for i in range(len(c)):
                if c[i] != conv:
                    conv, ctx = c[i], ROOT
                full.append(ctx + key[i])
                fin.append((seg[i] + 1) * segment >= m[i])
                base.append(seg[i] * segment)
                ctx = node_id(full[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.binary()), pa.array(fin), b.column(0), pa.array(base, pa.int64()), b.column(4)],
                ["full", "fin", "c", "base", "lens"])
    return (long.select("c", "m", "seg", "key", "lens").repartition("c").sortWithinPartitions("c", "seg")
            .mapInArrow(run, "full binary, fin boolean, c long, base long, lens array<int>"))


def trie_parts(rows: DataFrame, block_bytes: int, piece: int) -> DataFrame:
    def run(batches):
        def each():
            for b in batches:
                yield from zip(*(b.column(i).to_pylist() for i in range(5)))
        yield from batches_of(blocks(each(), TaskContext.get().partitionId(), block_bytes, piece), TYPES)

    at = ["full", "fin", "c"]
    return written(rows.select("full", "fin", "c", "base", "lens").repartitionByRange(*at).sortWithinPartitions(*at)
                   .mapInArrow(run, PARTS), "trie-parts")


def seams(parts: DataFrame) -> DataFrame:
    """What neighbouring tasks both count, taken back; one row per task comes in."""
    def run(batches):
        for b in batches:
            rows = (r for last, last_leaf, first, lens, leaf in zip(*(b.column(i).to_pylist() for i in range(5)))
                    for r in seam(last, last_leaf, first, lens, leaf))
            yield from batches_of(rows, pa.schema(list(TYPES)[1:10]))

    w = Window.orderBy("pid")
    pairs = parts.where(f"kind = {SEAM}").select(
        F.lag("last").over(w).alias("before"), F.lag("last_leaf").over(w).alias("before_leaf"), "first", "lens", "leaf")
    return pairs.where("before is not null").mapInArrow(run, NODES)


def endings(parts: DataFrame) -> DataFrame:
    """(node, ends): SHA-256 over the pieces of a node's conversation ids, as a stream."""
    def run(batches):
        node, sha, out = None, None, []
        for b in batches:
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k == node:
                    sha.update(b"," + text)
                else:
                    if node is not None:
                        out.append((node, sha.hexdigest()))
                    node, sha = k, hashlib.sha256(text)
        if node is not None:
            out.append((node, sha.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.string())],
                                         ["node", "ends"])
    return (parts.where(f"kind = {ENDS}").select("node", "text", "pid", "seq").repartition("node")
            .sortWithinPartitions("node", "pid", "seq").mapInArrow(run, "node binary, ends string"))


def at_depth(ctx: str, full: str, d: str) -> Column:
    """``node_id`` of the node ``d`` turns into a segment."""
    return F.expr(f"if({d} = 0, {ctx}, substring(unhex(sha2(substring({full}, 1, {ID} * ({d} + 1)), 256)), 1, {ID}))")


def lifted(rows: DataFrame, figures: DataFrame) -> DataFrame:
    """(node, leaves, saved): totals of later segments for all nodes ahead of them."""
    ctx = (rows.where("not fin").groupBy("full").agg(F.lit(1))
           .select("full", F.substring("full", 1, ID).alias("up"),
                   F.substring(F.unhex(F.sha2("full", 256)), 1, ID).alias("ctx")))
    ctx = written(ctx, "trie-contexts")
    own = figures.where("top").groupBy(F.col("node").alias("ctx")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    tot = ctx.join(own, "ctx").select("ctx", F.nullif("up", F.lit(ROOT)).alias("anc"), "leaves", "saved")
    while True:   # after k rounds a total covers 2^k segments, its pointer spans as many
        tot = written(tot, "trie-totals")
        if tot.where("anc is not null").limit(1).isEmpty():
            break
        more = tot.where("anc is not null").groupBy(F.col("anc").alias("ctx")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        up = tot.select(F.col("ctx").alias("anc"), F.col("anc").alias("next"))
        tot = tot.join(more, "ctx", "left").join(up, "anc", "left").select(
            "ctx", F.col("next").alias("anc"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"))
    rows = ctx.join(tot.select("ctx", "leaves", "saved"), "ctx").withColumn(
        "d", F.explode(F.expr(f"sequence(if(up = unhex('{ROOT.hex()}'), 0, 1), length(full) div {ID} - 1)")))
    return rows.select(at_depth("up", "full", "d").alias("node"), "leaves", "saved")


def prefix_trie(turns: DataFrame, sizes: DataFrame, segment: int = SEGMENT, block_bytes: int = BLOCK_BYTES,
                piece: int = PIECE) -> DataFrame:
    """(node, parent, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256) of the trie over (c, m, p, id, bytes): turn p of the m of conversation c."""
    segs = strings(turns, sizes, segment)
    rows = segs.where(F.col("m") <= segment).select(
        F.concat(F.lit(ROOT), "key").alias("full"), F.lit(True).alias("fin"), "c", F.lit(0).cast("long").alias("base"), "lens")
    long = segs.where(F.col("m") > segment)
    cut = not long.limit(1).isEmpty()
    if cut:
        long = written(chained(long, segment), "trie-chained")
        rows = rows.unionByName(long)
    parts = trie_parts(rows, block_bytes, piece)
    names = [f.split()[0] for f in NODES.split(", ")]
    figures = parts.where(f"kind = {NODE}").select(*names, "ends").unionByName(seams(parts), allowMissingColumns=True)
    figures = figures.unionByName(endings(parts), allowMissingColumns=True)
    if cut:
        up = lifted(long, figures)
        for k in ("leaves", "saved"):
            figures = figures.withColumn(k, F.when(F.col("top"), 0).otherwise(F.col(k)))
        figures = figures.unionByName(up, allowMissingColumns=True)
    nodes = written(figures.groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv").alias("conv_id"), F.sum("n").alias("n_convs"),
        F.sum("kids").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
        F.coalesce(F.max("ends"), F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")), "trie-nodes")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(above, "parent", "left")


def rebuilt(turns: DataFrame, family: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversation c becomes the first h turns of conversation c - c % ``family`` and its own
    after its first h, with h = crc32(c) % (``most`` + 1): (c, m, p, id, bytes) and (c, m)."""
    head = turns.where((F.col("pos") <= most) & (F.col("c") % family == 0)).groupBy(F.col("c").alias("b")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "id", "bytes"))).alias("head"))
    h = F.crc32(F.col("c").cast("string").cast("binary")) % (most + 1)
    plan = (turns.groupBy("c").agg(F.count("*").alias("own")).withColumn("h", h).withColumn("b", F.col("c") - F.col("c") % family)
            .join(head, "b", "left")
            .withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.array().cast("array<struct<pos:long,id:binary,bytes:int>>")))
            .withColumn("k", F.size("head")).withColumn("m", F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    plan = written(plan.select("c", "h", "k", "m", "head"), "trie-plan")
    own = turns.where(F.col("pos") > h).join(plan.select("c", "h", "k", "m"), "c").select(
        "c", "m", (F.col("k") + F.col("pos") - F.col("h")).alias("p"), "id", "bytes")
    lent = plan.select("c", "m", F.posexplode("head").alias("i", "x")).select(
        "c", "m", (F.col("i") + 1).cast("long").alias("p"), "x.id", "x.bytes")
    return own.unionByName(lent), plan.select("c", "m")


def op11_tries(spark, sf_dir):
    turns = ordered(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))
    return prefix_trie(*rebuilt(turns)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


#: The same trie with whole prefixes as lists; CRC-32 by its definition, bit by bit.
ORACLE = r"""
WITH turn AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
             sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
  SELECT c, count(*) AS own,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
             lambda crc, b: list_reduce(list_concat([xor(crc, b)], list_transform(range(8), lambda i: 0::BIGINT)),
                 lambda y, z: xor(y >> 1, 3988292384::BIGINT * (y & 1)) + z)), 4294967295::BIGINT) % 9 AS h
  FROM turn GROUP BY c),
lent AS (SELECT v.c, t.pos AS p, t.role, t.text FROM conv v JOIN turn t ON t.c = v.c - v.c % 5 AND t.pos <= v.h),
whole AS (
  SELECT * FROM lent UNION ALL
  SELECT t.c, t.pos - v.h + (SELECT count(*) FROM lent l WHERE l.c = v.c), t.role, t.text
  FROM turn t JOIN conv v ON v.c = t.c AND t.pos > v.h),
step AS (
  SELECT c, p AS d, text, list(row(role, text)) OVER (PARTITION BY c ORDER BY p ROWS UNBOUNDED PRECEDING) AS prefix
  FROM whole UNION ALL SELECT c, 0, '', [] FROM conv),
place AS (SELECT c, d, text, dense_rank() OVER (ORDER BY d, prefix) AS node, max(d) OVER (PARTITION BY c) AS m FROM step),
node AS (
  SELECT node, min(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(strlen(text)) AS own,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = m), '')) AS ends_sha256
  FROM place GROUP BY node),
below AS (
  SELECT a.node AS above, n.node, n.depth, n.own FROM node n JOIN place a ON a.c = n.conv_id AND a.d <= n.depth),
kids AS (SELECT b.above AS node, count(*) AS k FROM below b JOIN node n ON n.node = b.above AND b.depth = n.depth + 1 GROUP BY 1),
sums AS (
  SELECT b.above AS node, count(*) FILTER (k.k IS NULL) AS n_leaves, sum(b.own)::BIGINT AS saved_tokens
  FROM below b LEFT JOIN kids k ON k.node = b.node GROUP BY 1)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.k, 0) AS n_children, s.n_leaves,
       s.saved_tokens, n.ends_sha256
FROM node n JOIN sums s USING (node) LEFT JOIN kids k USING (node)
LEFT JOIN place a ON a.c = n.conv_id AND a.d = n.depth - 1 LEFT JOIN node up ON up.node = a.node
"""
