"""Phrase collocations from a weighted de Bruijn graph of word trigrams.

Nodes are word pairs, an edge is a trigram from its first pair to its last, weighted by its
count. Every word occurrence starts exactly one counted item: a trigram, or, at the end of a
piece, a pair or a single word. So only the longest grams are counted, and the shorter counts
follow: a pair occurs as often as flows out of its node plus the pieces that end in it, a
word as often as its pairs plus the pieces that end in it.

Items are counted per task in large batches and leave it in blocks, dealt by a hash of their
pair, so all edges of a node meet in one bucket: edge weights and node flows need one shuffle.
A frequent pair sends each batch's distinct followers only. Paths of nodes that one edge enters
and one edge leaves, with all their flow, are compacted by pointer doubling; inside such a path
every pair has the path's weight.

Buckets grow in number with the input's size, a bucket holds about ``BUCKET_BYTES`` of it.

Defined results: null and empty texts have no words; a null language counts as ``und``; repeated
rows count every time; ids are not read; ties go by score, count and phrase in UTF-8 order;
a very long text is read in stretches that end at a piece's end; words longer than a batch are
kept whole; an empty table gives no rows; only the text and language columns are read, so others may
have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, written

BATCH = 3_000_000        # word occurrences counted at once in a task
VOCABULARY = 1 << 21     # distinct words of a batch, so that three numbers fit 63 bits
BLOCK = 8_192            # lines of one shuffled block
BUCKET_BYTES = 8 << 20
STRETCH = 1 << 20
PATH = 512               # edges in one row of a compacted path
ENDS = bytes(b".,;:!?\x0a\x0b\x0c\x0d")
TABLE = bytes.maketrans(ENDS + b"\t" + bytes(range(65, 91)), b"\n" * len(ENDS) + b" " + bytes(range(97, 123)))


class Numbers(dict):
    """Words to numbers from 1, in order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


def stretches(text: bytes):
    """The text, lower-cased, with pieces separated by newlines, cut at pieces' ends."""
    lo, text = 0, text.translate(TABLE)
    while len(text) - lo > STRETCH:
        hi = text.find(b"\n", lo + STRETCH)
        if hi < 0:
            break
        yield text[lo:hi]
        lo = hi + 1
    yield text[lo:] if lo else text


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def blocks(lang: str, numbers: Numbers, ids: np.ndarray, buckets: int):
    """Counted items of a batch as (lang, bucket, lines, counts): a line is "u v<tab>w<newline>",
    with an empty v or w at a piece's end."""
    a = np.concatenate((ids, np.zeros(2, np.int64)))
    u, v, w = a[:-2], a[1:-1], a[2:]
    live = u > 0
    u, v, w = u[live], v[live], w[live]
    w = np.where(v > 0, w, 0)
    if len(numbers) < VOCABULARY:
        key, n = np.unique(u << 42 | v << 21 | w, return_counts=True)
        u, v, w = key >> 42, (key >> 21) & (VOCABULARY - 1), key & (VOCABULARY - 1)
    else:                                    # one stretch without a piece's end may hold more words
        (u, v, w), n = np.unique(np.stack([u, v, w]), axis=1, return_counts=True)
    h = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
    h = np.concatenate((np.zeros(1, np.uint64), h))
    bucket = (mix(h[u] * np.uint64(3) + mix(h[v])) % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    u, v, w, n, bucket = u[by], v[by], w[by], n[by], bucket[by]
    word = pa.array([b"", *numbers], pa.large_binary())
    empty = pa.scalar(b"", pa.large_binary())
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)]):
        for x in range(lo, hi, BLOCK):
            y = min(hi, x + BLOCK)
            line = pc.binary_join_element_wise(
                pc.binary_join_element_wise(
                    pc.binary_join_element_wise(word.take(u[x:y]), word.take(v[x:y]), pa.scalar(b" ", pa.large_binary())),
                    word.take(w[x:y]), pa.scalar(b"\t", pa.large_binary())),
                empty, pa.scalar(b"\n", pa.large_binary()))
            data = line.buffers()[2].slice(0, np.frombuffer(line.buffers()[1], np.int64)[y - x]).to_pybytes()
            raw = np.asarray(n[x:y], "<i8").tobytes()
            yield lang, int(bucket[x]), len(data), pa.compress(data, "zstd", asbytes=True), y - x, pa.compress(raw, "zstd", asbytes=True)


ITEMS = "lang string, bucket long, size long, lines binary, n long, counts binary"


def counted(docs: DataFrame, buckets: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """Blocks of counted items of all texts."""
    def run(batches):
        held: dict[str, tuple[Numbers, list]] = {}
        size = 0

        def flush():
            out = []
            for lang in sorted(held):
                numbers, parts = held[lang]
                for row in blocks(lang, numbers, np.concatenate(parts), buckets):
                    out.append(row)
                    if len(out) == 100:
                        yield batch(out)
                        out = []
            held.clear()
            if out:
                yield batch(out)

        def batch(out):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary()))],
                ["lang", "bucket", "size", "lines", "n", "counts"])

        for b in batches:
            for text, lang in zip(b.column(0), b.column(1).to_pylist()):
                text = text.as_py()
                for part in stretches(text) if text else ():
                    numbers, parts = held.setdefault(lang, (Numbers(), []))
                    ids: list[int] = []
                    for piece in part.split(b"\n"):
                        ws = piece.split(b" ") if b"  " not in piece else [w for w in piece.split(b" ") if w]
                        ids.extend(map(numbers.__getitem__, filter(None, ws)))
                        ids.append(0)
                    parts.append(np.array(ids, np.int64))
                    size += len(ids)
                    if size > BATCH or len(numbers) > VOCABULARY - STRETCH // 2 - 2:
                        yield from flush()
                        size = 0
        yield from flush()

    return docs.select(F.col(text).cast("binary").alias("t"), F.coalesce(lang, F.lit("und")).alias("l")).mapInArrow(run, ITEMS)


def bucket_counts(size: list[int], lines: list[bytes], n: list[int], counts: list[bytes]):
    """(words, keys, weights) of a bucket: its distinct words, and per distinct item the
    numbers of u, v, w in them, sorted, and its count. Words end in their separator, so an
    empty v or w is the separator alone."""
    data = b"".join(pa.decompress(x, s, "zstd", asbytes=True) for x, s in zip(lines, size))
    weight = np.concatenate([np.frombuffer(pa.decompress(x, 8 * k, "zstd", asbytes=True), "<i8") for x, k in zip(counts, n)])
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero((raw == 32) | (raw == 9) | (raw == 10)) + 1
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    token = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    d = token.dictionary_encode()
    ids = d.indices.to_numpy().astype(np.int64).reshape(-1, 3)
    pair, at = np.unique(ids[:, 0] << 32 | ids[:, 1], return_inverse=True)
    item, back = np.unique(at << 32 | ids[:, 2], return_inverse=True)
    total = np.zeros(len(item), np.int64)
    np.add.at(total, back, weight)
    pair = pair[item >> 32]
    return d.dictionary, np.stack([pair >> 32, pair & 0xFFFFFFFF, item & 0xFFFFFFFF], axis=1), total


def flows(blocks: DataFrame, min_count: int) -> DataFrame:
    """(lang, k, phrase, n): trigrams and pairs with ``min_count`` occurrences or more (k = 3, 2),
    and each word's occurrences as starts of a bucket's pairs and at pieces' ends (k = 1, to be summed)."""
    def emit(lang, size, lines, n, counts):
        words, key, weight = bucket_counts(size, lines, n, counts)
        spell = words.to_pylist()
        blank = np.array([x in (b"\t", b"\n") for x in spell])
        tri = ~blank[key[:, 1]] & ~blank[key[:, 2]]
        new = np.concatenate(([True], (key[1:, :2] != key[:-1, :2]).any(axis=1)))
        at = np.flatnonzero(new)
        flow, node = np.add.reduceat(weight, at), key[at]
        first, back = np.unique(key[:, 0], return_inverse=True)
        one = np.zeros(len(first), np.int64)
        np.add.at(one, back, weight)
        out_k, out_p, out_n = [], [], []
        for i in np.flatnonzero(tri & (weight >= min_count)):
            out_k.append(3)
            out_p.append(b" ".join(spell[j][:-1] for j in key[i]))
            out_n.append(weight[i])
        for i in np.flatnonzero(~blank[node[:, 1]] & (flow >= min_count)):
            out_k.append(2)
            out_p.append(spell[node[i, 0]] + spell[node[i, 1]][:-1])
            out_n.append(flow[i])
        out_k += [1] * len(first)
        out_p += [spell[i][:-1] for i in first]
        out_n += one.tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(out_k), pa.string()), pa.array(out_k, pa.int32()),
             pa.array(out_p, pa.binary()).cast(pa.string()), pa.array(out_n, pa.int64())], ["lang", "k", "phrase", "n"])

    def run(batches):
        key, held = None, ([], [], [], [])
        for b in batches:
            for row in zip(*[b.column(i).to_pylist() for i in range(6)]):
                if row[:2] != key:
                    if key:
                        yield from emit(key[0], *held)
                    key, held = row[:2], ([], [], [], [])
                for h, x in zip(held, row[2:]):
                    h.append(x)
        if key:
            yield from emit(key[0], *held)

    return (blocks.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket")
            .mapInArrow(run, "lang string, k int, phrase string, n long"))


def input_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def rest(phrase: str):
    """The phrase without its first word."""
    return F.expr(f"substring({phrase}, length(substring_index({phrase}, ' ', 1)) + 2)")


def compacted(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, head, part, words, a): the maximal paths whose inner pairs are entered by one edge
    and left by one edge with all their flow; ``PATH`` edges a row. ``open_left`` and
    ``open_right`` tell whether the row's first and last pair are such inner ones."""
    e = edges.select("lang", F.col("phrase").alias("edge"), F.col("n").alias("a"),
                     F.substring_index("phrase", " ", 2).alias("src"), rest("phrase").alias("dst"))
    none = F.lit(None)
    sides = (e.select("lang", F.col("dst").alias("node"), none.cast("long").alias("f"), F.struct("a", "edge").alias("enter"),
                      none.cast("struct<a:long,edge:string>").alias("leave"))
             .unionByName(e.select("lang", F.col("src").alias("node"), none.cast("long").alias("f"),
                                   none.cast("struct<a:long,edge:string>").alias("enter"), F.struct("a", "edge").alias("leave")))
             .unionByName(pairs.select("lang", F.col("phrase").alias("node"), F.col("n").alias("f"),
                                       none.cast("struct<a:long,edge:string>").alias("enter"),
                                       none.cast("struct<a:long,edge:string>").alias("leave"))))
    inner = written(sides.groupBy("lang", "node").agg(F.max("f").alias("f"), F.max("enter").alias("enter"), F.max("leave").alias("leave"))
                    .where("enter.a = f and leave.a = f")
                    .select("lang", F.col("leave.edge").alias("edge"), F.col("enter.edge").alias("prev")), "phrase-inner")
    at = inner.select("lang", "edge", "prev", F.lit(1).cast("long").alias("d"))
    while True:    # after k rounds a pointer spans 2^k edges or ends at its path's first one
        far = at.select("lang", F.col("edge").alias("prev"), F.col("prev").alias("_p"), F.col("d").alias("_d"))
        at = written(at.join(far, ["lang", "prev"], "left").select(
            "lang", "edge", F.coalesce("_p", "prev").alias("prev"), (F.col("d") + F.coalesce("_d", F.lit(0))).alias("d"),
            F.col("_p").isNotNull().alias("moved")), "phrase-pointers")
        if at.where("moved").limit(1).isEmpty():
            break
        at = at.drop("moved")
    tails = inner.select("lang", F.col("prev").alias("edge"), F.lit(True).alias("more"))
    placed = (e.select("lang", "edge", "a").join(at.select("lang", "edge", "prev", "d"), ["lang", "edge"], "left")
              .join(tails, ["lang", "edge"], "left")
              .select("lang", "a", "edge", F.coalesce("prev", "edge").alias("head"), F.coalesce("d", F.lit(0)).alias("d"),
                      F.coalesce("more", F.lit(False)).alias("more")))
    rows = placed.groupBy("lang", "head", F.expr(f"d div {PATH}").alias("part")).agg(
        F.max("a").alias("a"), F.sort_array(F.collect_list(F.struct("d", "edge", "more"))).alias("es"))
    return rows.select(
        "lang", "head", "part", "a",
        F.concat(F.split(F.col("es")[0]["edge"], " "),
                 F.transform(F.slice("es", 2, PATH), lambda x: F.substring_index(x["edge"], " ", -1))).alias("words"),
        (F.col("es")[0]["d"] > 0).alias("open_left"), F.element_at("es", -1)["more"].alias("open_right"))


def score(a, left, right):
    """floor(1000000 * a * a / (left * right)), exactly."""
    big = lambda c, p: c.cast(f"decimal({p},0)")
    return F.call_function("div", big(F.lit(1_000_000) * big(a, 14) * big(a, 14), 38), big(big(left, 18) * big(right, 18), 38))


def collocations(docs: DataFrame, min_count: int = 10, contained: int = 50, top: int | None = 2000,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best phrases of two or three words."""
    buckets = max(4, -(-input_bytes(docs) // BUCKET_BYTES))
    found = written(flows(counted(docs, buckets, text, lang), min_count), "phrase-flows")
    word = written(found.where("k = 1").groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "phrase-words")
    total = word.groupBy("lang").agg(F.sum("n").alias("total"))
    pairs, edges = found.where("k = 2").select("lang", "phrase", "n"), found.where("k = 3").select("lang", "phrase", "n")
    paths = written(compacted(edges, pairs), "phrase-paths")
    # the trigrams of a path are its windows; between them every pair has the path's weight
    i = F.col("i")
    tri = paths.withColumn("i", F.explode(F.expr("sequence(1, size(words) - 2)"))).select(
        "lang", "a", *[F.element_at("words", i + k).alias(c) for k, c in enumerate("uvw")],
        ((i > 1) | F.col("open_left")).alias("in_l"), ((i < F.size("words") - 2) | F.col("open_right")).alias("in_r"))
    tri = tri.withColumn("uv", F.concat_ws(" ", "u", "v")).withColumn("vw", F.concat_ws(" ", "v", "w"))
    inside = tri.where("in_l and in_r").withColumn("l2", F.col("a")).withColumn("r2", F.col("a"))
    look = lambda key, out: pairs.select("lang", F.col("phrase").alias(key), F.col("n").alias(out))
    outside = tri.where("not (in_l and in_r)").join(look("uv", "l2"), ["lang", "uv"]).join(look("vw", "r2"), ["lang", "vw"])
    heavy = word.where(F.col("n") >= min_count)
    one = lambda key, out: heavy.select("lang", F.col("phrase").alias(key), F.col("n").alias(out))
    tri = (inside.unionByName(outside).join(one("u", "l1"), ["lang", "u"]).join(one("w", "r1"), ["lang", "w"])
           .withColumn("s1", score(F.col("a"), F.col("l1"), F.col("r2"))).withColumn("s2", score(F.col("a"), F.col("l2"), F.col("r1")))
           .select("lang", F.concat_ws(" ", "u", "v", "w").alias("phrase"), "a",
                   F.when(F.col("s1") <= F.col("s2"), F.col("l1")).otherwise(F.col("l2")).alias("l"),
                   F.when(F.col("s1") <= F.col("s2"), F.col("r2")).otherwise(F.col("r1")).alias("r"),
                   F.least("s1", "s2").alias("score")))
    # a path's inner pairs lie in a trigram as frequent as they are; the rest ask their edges
    around = paths.select("lang", "a", F.posexplode(F.expr("transform(sequence(1, size(words) - 1), i -> words[i - 1] || ' ' || words[i])"))
                          .alias("j", "phrase"))
    longest = around.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    two = (pairs.withColumnRenamed("n", "a").join(longest, ["lang", "phrase"], "left")
           .where(F.coalesce(100 * F.col("longer") < contained * F.col("a"), F.lit(True)))
           .withColumn("u", F.substring_index("phrase", " ", 1)).withColumn("w", rest("phrase"))
           .join(one("u", "l"), ["lang", "u"]).join(one("w", "r"), ["lang", "w"])
           .select("lang", "phrase", "a", "l", "r", score(F.col("a"), F.col("l"), F.col("r")).alias("score")))
    ranked = tri.unionByName(two).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long"))
    if top:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(total.withColumnRenamed("total", "n"), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir):
    return collocations(documents(spark, sf_dir))


#: Words, pieces and phrase counts in plain SQL.
ORACLE = r"""
WITH piece AS (
  SELECT lang, doc, generate_subscripts(ps, 1) AS pno, unnest(ps) AS p FROM (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
           regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[.,;:!?\x0A-\x0D]') AS ps
    FROM documents)),
word AS (
  SELECT lang, doc, pno, generate_subscripts(ws, 1) AS i, unnest(ws) AS w
  FROM (SELECT lang, doc, pno, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM piece)),
gram AS (
  SELECT lang, w AS w1, lead(w) OVER x AS w2, lead(w, 2) OVER x AS w3 FROM word
  WINDOW x AS (PARTITION BY lang, doc, pno ORDER BY i)),
f1 AS (SELECT lang, w1 AS p, count(*) AS n FROM gram GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, w1 || ' ' || w2 AS p, count(*) AS n FROM gram WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, w1 || ' ' || w2 || ' ' || w3 AS p, count(*) AS n FROM gram WHERE w3 IS NOT NULL GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f1 GROUP BY lang),
cut AS (
  SELECT c.lang, c.p, c.n AS a, 1 AS k, l.n AS l, r.n AS r FROM f2 c
  JOIN f1 l ON l.lang = c.lang AND l.p = c.w1 JOIN f1 r ON r.lang = c.lang AND r.p = c.w2 WHERE c.n >= 10
    AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = c.lang AND t.n >= 10 AND 100 * t.n >= 50 * c.n
                    AND t.w1 = c.w1 AND t.w2 = c.w2)
    AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = c.lang AND t.n >= 10 AND 100 * t.n >= 50 * c.n
                    AND t.w2 = c.w1 AND t.w3 = c.w2)
  UNION ALL
  SELECT c.lang, c.p, c.n, 1, l.n, r.n FROM f3 c
  JOIN f1 l ON l.lang = c.lang AND l.p = c.w1 JOIN f2 r ON r.lang = c.lang AND r.w1 = c.w2 AND r.w2 = c.w3 WHERE c.n >= 10
  UNION ALL
  SELECT c.lang, c.p, c.n, 2, l.n, r.n FROM f3 c
  JOIN f2 l ON l.lang = c.lang AND l.w1 = c.w1 AND l.w2 = c.w2 JOIN f1 r ON r.lang = c.lang AND r.p = c.w3 WHERE c.n >= 10),
scored AS (
  SELECT lang, p, a, k, l, r, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cut),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM lowest)
SELECT r.lang, r.rank, r.p AS phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN total t ON t.lang = r.lang WHERE r.rank <= 2000
"""
