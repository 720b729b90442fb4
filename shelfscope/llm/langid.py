"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts are gathered per task as (language, bucket) arrays and summed by Spark; the matrix of
log probabilities has ``languages x buckets`` cells whatever the corpus size, so it is
broadcast. A batch is scored as one sparse sum: every n-gram of the batch looks its row up
and the rows are summed per document.

Defined results: null text or a text without a letter is ``und`` with score 0, as is every
text when no labelled document exists; ties between languages go to the first by name;
labels may be null (not learned from); repeated and empty texts are scored one by one.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents

BITS = 15          # buckets per n-gram length
ORDERS = (2, 3)
LETTER = re.compile(r"[^\W\d_]")
MULT = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
STEP = 1 << 20     # characters scored at once


def ngrams(text: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Bucket of every n-gram of the texts, one array per order (aligned to the first
    character, blanks outside a text), and the texts' starts. Case is folded and runs of
    other characters than letters count as one blank; the two blanks ahead of each text keep
    n-grams from reaching into the next one."""
    folded = ["  " + " ".join(re.findall(r"[^\W\d_]+", t.lower())) + " " for t in text]
    starts = np.concatenate(([0], np.cumsum([len(t) for t in folded])[:-1])).astype(np.int64)
    c = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, h = [], c * MULT[0]
    for n in range(1, max(ORDERS)):
        nxt = np.concatenate((c[n:], np.full(n, 32, np.uint64)))
        h = (h ^ (h >> np.uint64(29))) * MULT[1] + nxt * MULT[2]
        if n + 1 in ORDERS:
            x = h ^ (h >> np.uint64(32))
            x *= MULT[0]
            out.append(((x >> np.uint64(64 - BITS)).astype(np.int32)) + (len(out) << BITS))
    return out, starts


def train(docs: DataFrame, text: str = "text", label: str = "lang", where: Column | None = None,
          smoothing: float = 0.1) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log prior, log probability [language, bucket]) of the labelled rows.

    Every labelled row counts; what reaches the driver is one sum per language and bucket.
    """
    width = len(ORDERS) << BITS
    d = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    d = (d if where is None else d.where(where)).select(text, label)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            t, lab = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), object)
            for name in sorted(set(lab)):
                pick = [t[i] for i in np.flatnonzero(lab == name)]
                s = sums.setdefault(name, np.zeros(width + 1, np.int64))
                s[width] += len(pick)
                for part in portions(pick):
                    for g in ngrams(part)[0]:
                        s[:width] += np.bincount(g, minlength=width)
        for name, s in sums.items():
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at), pa.string()),
                                              "bucket": at.astype(np.int32), "n": s[at]})

    rows = (d.mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    names = sorted(set(rows.column("lang").to_pylist()))
    m = np.zeros((len(names), width + 1))
    if names:
        at = np.searchsorted(np.array(names, object), np.array(rows.column("lang").to_pylist(), object))
        m[at, rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    prior = np.log(m[:, width] / max(1.0, m[:, width].sum())) if names else np.zeros(0)
    p = np.empty((len(names), width), np.float32)
    for o in range(len(ORDERS)):
        part = slice(o << BITS, (o + 1) << BITS)
        s = m[:, part] + smoothing
        p[:, part] = np.log(s / s.sum(axis=1, keepdims=True))
    return names, prior, p


def portions(text: list[str], size: int = STEP):
    part, n = [], 0
    for t in text:
        if part and n + len(t) > size:
            yield part
            part, n = [], 0
        part.append(t)
        n += len(t)
    if part:
        yield part


def predict(docs: DataFrame, model, id_cols: list[str], text: str = "text") -> DataFrame:
    """``id_cols`` with lang_pred and score (posterior probability of the language)."""
    names, prior, logp = model
    shared = docs.sparkSession.sparkContext.broadcast((names, prior, logp))

    def run(batches):
        names, prior, logp = shared.value
        for b in batches:
            t = b.column(text).to_pylist()
            lang, score = np.full(len(t), "und", object), np.zeros(len(t))
            live = [i for i, x in enumerate(t) if x and LETTER.search(x)] if names else []
            done = 0
            for part in portions([t[i] for i in live]):
                grams, starts = ngrams(part)
                s = np.empty((len(part), len(names)))
                for k in range(len(names)):
                    s[:, k] = prior[k] + sum(np.add.reduceat(logp[k][g], starts, dtype=np.float64) for g in grams)
                best = s.argmax(axis=1)
                p = 1 / np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)
                at = live[done:done + len(part)]
                lang[at], score[at] = [names[k] for k in best], p
                done += len(part)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in id_cols] + [pa.array(lang.tolist(), pa.string()), pa.array(score)],
                [*id_cols, "lang_pred", "score"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in id_cols)
    return docs.select(*dict.fromkeys([*id_cols, text])).mapInArrow(run, f"{fields}, lang_pred string, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op8_langid(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = train(docs, where=~held_out())
    return predict(docs, model, ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
