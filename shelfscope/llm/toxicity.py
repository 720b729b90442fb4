"""Toxicity: cumulative-link (proportional-odds) ordinal regression on sparse word features.

P(grade > k) = sigmoid(w.x - b_k) with one weight vector for all thresholds b_0 < b_1 < ...;
the result is the expected severity, the sum of these probabilities. Features are the words
of the text (letters only, case folded) and the stems of longer ones by their 64-bit hash,
valued 1 + log(count).

Severity grades are learned from labels: grade 0 is "not toxic"; toxic documents are graded
by the share of their words that stand out in toxic documents, cut at quantiles.

Words are counted against the labels by Spark; the classifier is fitted on the driver on the
known words of a bounded sample of labelled documents (``max_rows``, those with the lowest
hash of their id): every word of at least ``min_docs`` of its documents with a chi-square of at least
``min_chi`` against the label. All documents are scored, each batch as one
sparse sum over the broadcast weights.

Defined results: null or wordless text has the intercepts alone; documents without a label
are not learned from; a document labelled twice counts as toxic if any label says so, and of several
texts under one id the least is learned from; without a toxic and a clean label the severity is
0 for all; repeated rows and rows without an id are scored one by one; very long texts are scored
whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, written


STEM = 6
FLAG = 0.3  # least probability of any toxicity that flags a document; clean ones lie far below


def with_features(df: DataFrame, text: str, out: str = "h") -> DataFrame:
    """``out``: hashes of a text's words and of longer words' first ``STEM`` letters, repeats
    included."""
    df = df.withColumn("_w", F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"), ""))
    stems = F.transform(F.filter("_w", lambda x: F.length(x) > STEM),
                        lambda x: F.xxhash64(F.lit("stem"), F.substring(x, 1, STEM)))
    return df.withColumn(out, F.concat(F.transform("_w", lambda x: F.xxhash64(x)), stems)).drop("_w")


def sparse(lists: list[np.ndarray], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of the known words of each list, values 1 + log(count)."""
    n = np.array([len(x) for x in lists], np.int64)
    flat = np.concatenate(lists) if len(lists) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(lists)), n)
    at = np.searchsorted(vocabulary, flat)
    at[at == len(vocabulary)] = 0
    ok = vocabulary[at] == flat if len(vocabulary) else np.zeros(len(flat), bool)
    key, count = np.unique(row[ok] * max(1, len(vocabulary)) + at[ok], return_counts=True)
    return key // max(1, len(vocabulary)), key % max(1, len(vocabulary)), 1 + np.log(count)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def fit_ordinal(row, col, val, grade: np.ndarray, width: int, penalty: float = 5e-5, rounds: int = 600,
                rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by maximum likelihood (Adam on the full sample)."""
    n, k = len(grade), int(grade.max())
    share = np.array([(grade > j).mean() for j in range(k)])
    b0, gaps = -np.log(share[0] / (1 - share[0])), np.log(np.maximum(np.diff(-np.log(share / (1 - share))), 0.1))
    theta = np.concatenate([np.zeros(width), [b0], gaps])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        w, b = theta[:width], theta[width] + np.concatenate([[0], np.cumsum(np.exp(theta[width + 1:]))])
        z = np.bincount(row, val * w[col], n)
        up = sigmoid(z[:, None] - b)                      # P(grade > j)
        edge = np.concatenate([np.ones((n, 1)), up, np.zeros((n, 1))], axis=1)
        i = np.arange(n)
        p = np.maximum(edge[i, grade] - edge[i, grade + 1], 1e-12)
        slope = edge * (1 - edge)
        gz = -(slope[i, grade] - slope[i, grade + 1]) / p / n
        gb = np.zeros(k)
        for j in range(k):                                # d/db_j of -log p
            gb[j] = (np.where(grade == j + 1, slope[:, j + 1], 0) - np.where(grade == j, slope[:, j + 1], 0))\
                .__truediv__(p).sum() / n
        g = np.concatenate([np.bincount(col, val * gz[row], width) + penalty * w, [gb.sum()],
                            np.exp(theta[width + 1:]) * np.cumsum(gb[::-1])[::-1][1:]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return theta[:width], theta[width] + np.concatenate([[0], np.cumsum(np.exp(theta[width + 1:]))])


def train(docs: DataFrame, labels: DataFrame, grades: int = 3, max_rows: int = 20_000,
          min_docs: int = 3, min_chi: float = 10.83):
    """(vocabulary, weights, thresholds) from documents with a ``toxic`` label."""
    lab = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
           .select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")))
    n = lab.count()
    pick = F.shiftrightunsigned(F.xxhash64(F.lit(5), "_id"), 33) / F.lit(float(1 << 31)) < min(1.0, 0.95 * max_rows / max(1, n))
    rows = docs.select("doc_id", "text").join(lab.where(pick), F.col("doc_id") == F.col("_id")).groupBy("_id").agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = written(with_features(rows, "text").select("_id", "toxic", "h"), "toxicity-sample")
    n1, n0 = (int(x or 0) for x in rows.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first())
    if not n1 or not n0:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
    # chi-square of word against label: what chance explains would only be fitted as noise
    seen, bad = F.col("seen"), F.col("bad")
    chi = (F.lit(float(n1 + n0)) * F.pow(bad * n0 - (seen - bad) * n1, 2)
           / (F.lit(float(n1) * n0) * seen * F.greatest(n1 + n0 - seen, F.lit(0.5))))
    words = (rows.select("toxic", F.explode(F.array_distinct("h")).alias("w")).groupBy("w")
             .agg(F.count("*").alias("seen"), F.sum("toxic").alias("bad")).where(seen >= min_docs)
             .where(chi >= min_chi).toArrow())         # bounded by the sample
    word, seen, bad = (words.column(k).to_numpy() for k in ("w", "seen", "bad"))
    by = np.argsort(word)
    vocabulary, seen, bad = word[by], seen[by], bad[by]
    odds = np.log((bad + 0.5) / (n1 + 1)) - np.log((seen - bad + 0.5) / (n0 + 1))
    marks = vocabulary[(odds > 3) & (bad >= max(min_docs, 0.02 * n1))]  # stand out in toxic documents
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, marks))

    def known(batches):
        vocabulary, marks = shared.value
        for b in batches:
            lists = [np.asarray(x, np.int64) for x in b.column(2).to_pylist()]
            row, col, val = sparse(lists, vocabulary)
            cut = np.searchsorted(row, np.arange(len(lists) + 1))
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array([np.isin(x, marks).mean() if len(x) else 0.0 for x in lists], pa.float64()),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(col, pa.int64())),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(val, pa.float64()))],
                ["_id", "toxic", "share", "col", "val"])
    sample = rows.mapInArrow(known, "_id long, toxic int, share double, col array<long>, val array<double>").toArrow()
    order = np.argsort(sample.column("_id").to_numpy(), kind="stable")
    sample = sample.take(pa.array(order))
    toxic, share = sample.column("toxic").to_numpy() > 0, sample.column("share").to_numpy()
    col, val = (sample.column(k).combine_chunks() for k in ("col", "val"))
    row = np.repeat(np.arange(len(toxic)), pc.list_value_length(col).to_numpy())
    grade = np.zeros(len(toxic), int)
    cuts = np.quantile(share[toxic], np.arange(1, grades) / grades)
    grade[toxic] = 1 + np.searchsorted(np.unique(cuts), share[toxic], side="left")
    _, grade = np.unique(grade, return_inverse=True)
    w, b = fit_ordinal(row, col.flatten().to_numpy(), val.flatten().to_numpy(), grade, len(vocabulary))
    return vocabulary, w, b


def score(docs: DataFrame, model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, severity, p_toxic): expected severity and the probability of any toxicity."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        vocabulary, w, b = shared.value
        for batch in batches:
            h = batch.column(1)
            offsets = h.offsets.to_numpy()
            flat = h.values.to_numpy()[offsets[0]:offsets[-1]]
            z = np.zeros(batch.num_rows)
            if len(b):
                row, col, val = sparse([flat[x:y] for x, y in zip(offsets[:-1] - offsets[0], offsets[1:] - offsets[0])],
                                       vocabulary)
                z = np.bincount(row, val * w[col], batch.num_rows)
            p = sigmoid(z[:, None] - b)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "severity": p.sum(axis=1) if len(b) else z,
                "p_toxic": p[:, 0] if len(b) else z})

    d = with_features(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")), "text")
    return d.select("doc_id", "h").mapInArrow(
        run, "doc_id long, severity double, p_toxic double")


def op1_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return score(docs, train(docs, labels)).select(
        "doc_id", "severity", "p_toxic", (F.col("p_toxic") >= FLAG).alias("toxic"))
