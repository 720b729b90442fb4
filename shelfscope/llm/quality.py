"""Document quality: random-indexing word vectors, pooled per document, and a two-layer network.

Every token has a sparse random index vector of a few +1 and -1. A token's word vector is the
sum of the index vectors around it over all documents, scaled to length one; a document is
the mean of its tokens' vectors. Tokens are runs of letters (case folded), of digits and of
other signs; a word all in capitals and a token that repeats the one before leave a mark after them,
which is a token as well. Tokens are hashed to ``1 << BITS`` buckets, so the vectors' table has one
size whatever the corpus, and may be broadcast; the sums are whole numbers, so a rerun agrees
to the bit.

The network (one hidden layer of tanh units, one output) is fitted in numpy on the driver on
the pooled vectors of at most ``max_rows`` labelled documents in expectation, those of lowest hash.
A fifth of them is kept back from the fit to find the temperature its output is divided by.

Defined results: null, empty and tokenless texts have the zero vector and the score that goes
with it; texts are read whole, whatever their length; a document labelled twice counts as poor if any label says so;
of several texts under one id the one of least hash is learned from; rows without id or label
aren't learned from, and are scored; without both labels the score is the share of good ones
(0.5 without any); repeated rows are scored one by one; an empty table gives no rows; only the
id and text columns are read, so others may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents

BITS = 16
DIM = 64
SIGNS = 4                # non-zero places of an index vector
WINDOW = 2
BATCH = 2_000_000        # tokens gathered at once in a task
STRETCH = 1 << 18        # characters split into tokens at once
PARTS = 256              # rows the table of sums travels in
GOOD = 0.3               # least score of a good document
SPACE, LETTER, DIGIT, LINE, SIGN = range(5)
FACTOR = 0x9E3779B97F4A7C15
CAPITALS, REPEAT = 0, 1   # buckets of the two marks; tokens have the others


def char_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, small letter, is capital) of every character of the basic plane."""
    chars = [chr(i) for i in range(1 << 16)]
    kind = np.array([SPACE if x.isspace() else DIGIT if x.isdecimal() else LINE if x == "_" else LETTER if x.isalnum() else SIGN
                     for x in chars], np.uint8)
    low = np.array([ord(y) if len(y := x.lower()) == 1 else ord(x) for x in chars], np.uint64)
    return kind, low, np.array([x.isupper() for x in chars])


KIND, LOW, CAPITAL = char_tables()


def stretches(text: str):
    """The text cut at blanks, which no token holds."""
    lo = 0
    while len(text) - lo > STRETCH and (hi := text.find(" ", lo + STRETCH)) >= 0:
        yield text[lo:hi]
        lo = hi
    yield text[lo:] if lo else text


def tokens(texts: list[str | None]):
    """(text number, bucket) arrays of the tokens and marks of all texts, in order, for some
    ``STRETCH`` characters at a time."""
    parts, held, last = [], 0, (-1, 0)
    for i, t in enumerate(texts):
        for part in stretches(t) if t else ():
            parts.append((i, part))
            held += len(part)
            if held > STRETCH:
                doc, ids, last = split(parts, last)
                yield doc, ids
                parts, held = [], 0
    if parts:
        yield split(parts, last)[:2]


def split(parts: list[tuple[int, str]], last: tuple[int, int]):
    """Tokens of some texts; ``last`` is the text number and hash of the token before them."""
    c = np.frombuffer("".join([t + "\n" for _, t in parts]).encode("utf-32-le", "surrogatepass"), np.uint32)
    basic = np.minimum(c, 0xFFFF)            # characters beyond the basic plane are signs
    kind = KIND[basic]
    at = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1))
    size = np.diff(np.concatenate((at, [len(c)])))
    power = np.full(int(size.max()), FACTOR, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    place = np.arange(len(c)) - np.repeat(at, size)
    h = np.add.reduceat((np.where(c > 0xFFFF, c, LOW[basic]) + np.uint64(7)) * power[place], at)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    capital = (np.add.reduceat(CAPITAL[basic].astype(np.int32), at) == size) & (size > 1)
    word = kind[at] != SPACE
    start = np.cumsum([0] + [len(t) + 1 for _, t in parts])[:-1]
    doc = np.array([i for i, _ in parts])[np.searchsorted(start, at[word], side="right") - 1]
    h, capital = h[word], capital[word]
    if not len(h):
        return doc, np.zeros(0, np.int64), last
    again = np.concatenate(([doc[0] == last[0] and int(h[0]) == last[1]], (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])))
    n = 1 + again.astype(np.int64) + capital
    put = np.cumsum(n) - n
    ids = np.empty(int(n.sum()), np.int64)
    ids[put] = 2 + (h % np.uint64((1 << BITS) - 2)).astype(np.int64)
    ids[put[again] + 1] = REPEAT
    ids[(put + n - 1)[capital]] = CAPITALS
    return np.repeat(doc, n), ids, (int(doc[-1]), int(h[-1]))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of every bucket's index vector."""
    rng = np.random.default_rng(17)
    return rng.integers(0, DIM, (1 << BITS, SIGNS)), rng.choice([-1, 1], (1 << BITS, SIGNS))


def around(doc: np.ndarray, ids: np.ndarray, place: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Sums of index vectors within ``WINDOW`` of each bucket's tokens, and their number."""
    out = np.zeros(DIM << BITS)
    for gap in range(1, WINDOW + 1):
        same = (doc[gap:] == doc[:-gap]) & (doc[gap:] >= 0)
        a, b = ids[:-gap][same], ids[gap:][same]
        for x, y in ((a, b), (b, a)):
            for k in range(SIGNS):
                out += np.bincount(x * DIM + place[y, k], sign[y, k], DIM << BITS)
    return np.concatenate([out.reshape(-1, DIM), np.bincount(ids[doc >= 0], minlength=1 << BITS)[:, None]], axis=1).astype(np.int64)


def gathered(held: list[tuple[np.ndarray, np.ndarray]], place: np.ndarray, sign: np.ndarray) -> np.ndarray:
    return around(np.concatenate([d for d, _ in held]), np.concatenate([i for _, i in held]), place, sign)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The word vector of every bucket, from all documents."""
    place, sign = index_vectors()
    shared = docs.sparkSession.sparkContext.broadcast((place, sign))

    def count(batches):
        place, sign = shared.value
        total, held, size = np.zeros((1 << BITS, DIM + 1), np.int64), [], 0
        for b in batches:
            for doc, ids in tokens(b.column(0).to_pylist()):
                held.append((doc, ids))
                size += len(ids)
            if size > BATCH:                      # a batch of rows ends with a whole text
                total += gathered(held, place, sign)
                held, size = [], 0
            elif held:
                held.append((np.full(WINDOW, -1), np.zeros(WINDOW, np.int64)))   # between texts of two batches
        if held:
            total += gathered(held, place, sign)
        part = total.reshape(PARTS, -1)
        used = [i for i in range(PARTS) if part[i].any()]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(used, pa.int32()),
            "sums": pa.array([pa.compress(part[i].astype("<i8").tobytes(), "zstd", asbytes=True) for i in used], pa.binary())})

    width = (1 << BITS) // PARTS * (DIM + 1)

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for part, sums in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(pa.decompress(sums, 8 * width, "zstd", asbytes=True), "<i8")
                total[part] = total[part] + x if part in total else x
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(total), pa.int32()),
                                          "sums": pa.array([x.tobytes() for x in total.values()], pa.binary())})

    rows = (docs.select(text).mapInArrow(count, "part int, sums binary").repartition("part")
            .mapInArrow(add, "part int, sums binary").toArrow())
    sums = np.zeros((PARTS, width))
    for part, x in zip(rows.column("part").to_pylist(), rows.column("sums").to_pylist()):
        sums[part] = np.frombuffer(x, "<i8")
    v = sums.reshape(1 << BITS, DIM + 1)[:, :DIM]
    return (v / np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1)).astype(np.float32)


def pooled(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """The mean vector of every text's tokens."""
    out, n = np.zeros((len(texts), DIM)), np.zeros(len(texts))
    for doc, ids in tokens(texts):
        if len(ids):
            at = np.concatenate(([0], np.flatnonzero(doc[1:] != doc[:-1]) + 1))
            out[doc[at]] += np.add.reduceat(vectors[ids], at, axis=0, dtype=np.float64)
            n[doc[at]] += np.diff(np.concatenate((at, [len(ids)])))
    return out / np.maximum(n, 1)[:, None]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def forward(x: np.ndarray, net) -> np.ndarray:
    """The network's output before the sigmoid."""
    mean, scale, w1, b1, w2, b2, temperature = net
    return (np.tanh((x - mean) / scale @ w1 + b1) @ w2 + b2) / temperature


def loss(z: np.ndarray, y: np.ndarray) -> float:
    """Mean log loss against targets held off 0 and 1 by one row of either kind, so the
    temperature stays finite where the two kinds are apart."""
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    return float((t * np.logaddexp(0, -z) + (1 - t) * np.logaddexp(0, z)).mean())


def fit(x: np.ndarray, y: np.ndarray, back: np.ndarray, hidden: int = 24, rounds: int = 800, rate: float = 0.02,
        penalty: float = 1e-3):
    """The two layers by Adam on the rows not kept ``back``, then the temperature of least loss
    on those kept back."""
    rng = np.random.default_rng(3)
    tx, ty = x[~back], y[~back]
    mean, scale = tx.mean(axis=0), tx.std(axis=0) + 1e-6
    h = (tx - mean) / scale
    theta = [rng.normal(0, 1 / np.sqrt(h.shape[1]), (h.shape[1], hidden)), np.zeros(hidden),
             rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta]
    for t in range(1, rounds + 1):
        w1, b1, w2, b2 = theta
        a = np.tanh(h @ w1 + b1)
        d = (sigmoid(a @ w2 + b2) - ty) / len(ty)
        da = d[:, None] * w2 * (1 - a * a)
        grads = [h.T @ da + penalty * w1, da.sum(axis=0), a.T @ d + penalty * w2, np.array([d.sum()])]
        for i, g in enumerate(grads):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
            theta[i] = theta[i] - rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    net = (mean, scale, *theta, 1.0)
    if back.any() and len(set(y[back].tolist())) == 2:
        z = forward(x[back], net)
        grid = np.exp(np.linspace(np.log(0.25), np.log(16), 167))
        net = (*net[:-1], float(grid[np.argmin([loss(z / t, y[back]) for t in grid])]))
    return net


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, where: Column | None = None, max_rows: int = 20_000):
    """The network, or the one score of all where labels don't differ."""
    lab = labels.where("doc_id is not null and quality is not null")
    lab = (lab if where is None else lab.where(where)).groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.min("quality").cast("int").alias("y"))
    n = lab.count()
    pick = F.shiftrightunsigned(F.xxhash64(F.lit(23), "_id"), 33) / F.lit(float(1 << 31)) < min(1.0, 0.95 * max_rows / max(1, n))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(batches):
        for b in batches:
            x = pooled(b.column(2).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([r.tobytes() for r in x.astype("<f8")], pa.binary())], ["_id", "y", "x"])

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(lab.where(pick), F.col("doc_id") == F.col("_id"))
            .select("_id", "y", "text").mapInArrow(pool, "_id long, y int, x binary")
            .groupBy("_id").agg(F.min("y").alias("y"), F.min(F.struct(F.xxhash64("x").alias("h"), "x"))["x"].alias("x"))
            .orderBy("_id").toArrow())
    y = (rows.column("y").to_numpy() > 0).astype(float)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    x = np.stack([np.frombuffer(r, "<f8") for r in rows.column("x").to_pylist()])
    back = np.array([xxhash.xxh32_intdigest(str(i)) % 5 == 0 for i in rows.column("_id").to_pylist()])
    if len(set(y[~back].tolist())) < 2:
        back[:] = False
    return fit(x, y, back)


def scored(docs: DataFrame, vectors: np.ndarray, net, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score): the calibrated probability that a document is good."""
    shared = docs.sparkSession.sparkContext.broadcast((vectors, net))

    def run(batches):
        vectors, net = shared.value
        for b in batches:
            if isinstance(net, float):
                p = np.full(b.num_rows, net)
            else:
                p = sigmoid(forward(pooled(b.column(1).to_pylist(), vectors), net))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op12_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    vectors = word_vectors(docs)
    return scored(docs, vectors, train(docs, labels, vectors, where=~held_out())).select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= GOOD, 1).otherwise(0).alias("predicted"))
