"""Secret scans: fixed patterns plus character Markov models, in DataFrame expressions only.

Base spans come from three patterns. The method adds long tokens whose characters follow a
first-order Markov model of random strings rather than one of ordinary identifiers: the mean
log-likelihood ratio of their transitions is above a threshold. Both models are trained from
labelled samples drawn from a bounded number of documents: random strings are the values
that base patterns found, identifiers are plain words of letters and underscores.

Positions: splitting by a pattern gives the gaps between its leftmost non-overlapping
matches, so a match starts at the summed length of all gaps and matches before it. The sums
run over blocks, so a text with very many matches stays cheap.

Defined results: null text counts as empty, a text without a span gives empty strings (and
the digest of the empty string); without a labelled sample of both kinds the method adds
nothing; ties in the start go by the kind's place in the list; repeated rows are scanned one
by one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, positional

KINDS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
}
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789+/_=-"  # letters count without case
SIZE = len(ALPHABET) + 1  # 0: any other character
SPAN = "array<struct<start:int, kind:int, end:int, m:string>>"
BLOCK = 256


def with_spans(df: DataFrame, text: str, kind: int, pattern: str, out: str) -> DataFrame:
    """``out``: array of (start, kind, end, match) of all matches of ``pattern`` in ``text``."""
    p = F.lit(pattern)
    m, z, b = f"_m_{out}", f"_z_{out}", f"_b_{out}"
    some = F.size(m) > 0
    width = lambda x: x["g"] + x["l"]
    add = lambda acc, x: acc + x
    df = df.withColumn(m, F.regexp_extract_all(text, p, F.lit(0)))
    df = df.withColumn(z, F.when(some, F.zip_with(
        m, F.slice(F.split(text, pattern, -1), 1, F.size(m)),
        lambda a, g: F.struct(F.length(g).alias("g"), F.length(a).alias("l"), a.alias("m")))))
    df = df.withColumn(b, F.when(some, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(m) - 1) / BLOCK).cast("int")),
        lambda j: F.aggregate(F.slice(z, j * BLOCK + 1, BLOCK), F.lit(0), lambda acc, x: acc + width(x)))))

    def span(x: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        start = (F.aggregate(F.slice(b, F.lit(1), block), F.lit(0), add)
                 + F.aggregate(F.slice(z, block * BLOCK + 1, i - block * BLOCK), F.lit(0), lambda acc, y: acc + width(y))
                 + x["g"])
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x["l"]).alias("end"), x["m"].alias("m"))

    df = df.withColumn(out, F.coalesce(F.transform(z, span), F.array().cast(SPAN)))
    return df.drop(m, z, b)


def base_spans(df: DataFrame, text: str = "_t") -> DataFrame:
    """Column ``base``: the pattern spans, by start and kind."""
    for k, (kind, pattern) in enumerate(KINDS.items()):
        df = with_spans(df, text, k, pattern, kind)
    long_enough = F.filter("assign", lambda x: F.length(F.regexp_extract(x["m"], KINDS["assign"], 2)) >= 6)
    return df.withColumn("base", F.sort_array(F.concat(long_enough, "access", "hex"))).drop(*KINDS)


def code(s: Column, i: Column) -> Column:
    return F.instr(F.lit(ALPHABET), F.lower(F.substring(s, i, F.lit(1))))


def train(docs: DataFrame, text: str = "text", id_col: str = "doc_id", sample_docs: int = 4000,
          smoothing: float = 0.5, even: float = 0.5) -> list[float]:
    """Log-likelihood ratio (random against identifier) of each pair of characters, flattened;
    zeros if either sample is empty. ``sample_docs`` bounds the documents that samples come
    from (picked by a hash of the id). The random model is mixed with share ``even`` of an
    even distribution, so random strings of another alphabet than the samples' count too."""
    share = min(1.0, sample_docs / max(1, docs.count()))
    h = F.shiftrightunsigned(F.xxhash64(F.lit(3), id_col), 33) / F.lit(float(1 << 31))
    d = docs.where(h < share).select(F.coalesce(text, F.lit("")).alias("_t"))
    value = F.when(F.col("s.kind") == 0, F.regexp_extract("s.m", KINDS["assign"], 2)).otherwise(F.col("s.m"))
    random = base_spans(d).select(F.explode("base").alias("s")).select(F.lit(1).alias("label"), value.alias("w"))
    names = d.select(F.explode(F.regexp_extract_all("_t", F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z_]{4,}+(?![A-Za-z0-9+/_=-])"),
                                                    F.lit(0))).alias("w")).select(F.lit(0).alias("label"), "w")
    pairs = random.unionByName(names).where(F.length("w") > 1).groupBy("label", "w").count().select(
        "label", "count", "w", F.explode(F.expr("sequence(1, length(w) - 1)")).alias("i"))
    counts = pairs.groupBy("label", (code(F.col("w"), F.col("i")) * SIZE + code(F.col("w"), F.col("i") + 1)).alias("p")).agg(
        F.sum("count").alias("n")).collect()  # at most 2 * SIZE * SIZE rows
    n = [[smoothing] * (SIZE * SIZE) for _ in range(2)]
    seen = set()
    for r in counts:
        n[r["label"]][r["p"]] += r["n"]
        seen.add(r["label"])
    if len(seen) < 2:
        return [0.0] * (SIZE * SIZE)
    rows = [[sum(x[a * SIZE:(a + 1) * SIZE]) for a in range(SIZE)] for x in n]
    return [round(math.log((1 - even) * n[1][p] / rows[1][p // SIZE] + even / SIZE)
                  - math.log(n[0][p] / rows[0][p // SIZE]), 6) for p in range(SIZE * SIZE)]


def scan(docs: DataFrame, model: list[float], text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with arrays ``base`` (pattern spans) and ``spans`` (those and the method's)."""
    table = F.expr(f"cast(split('{','.join(map(str, model))}', ',') as array<double>)")
    markov = len(KINDS)
    d = base_spans(docs.withColumn("_t", F.coalesce(text, F.lit(""))))
    d = with_spans(d, "_t", markov, TOKEN, "_tokens")

    def ratio(s: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.length(s) - 1), F.lit(0.0), lambda acc, i: acc + F.element_at(
            table, code(s, i) * SIZE + code(s, i + 1) + 1)) / (F.length(s) - 1)

    new = F.filter("_tokens", lambda x: (ratio(x["m"]) > threshold) & ~F.exists(
        "base", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))
    return d.withColumn("spans", F.sort_array(F.concat("base", new))).drop("_tokens", "_t")


def joined(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in [*KINDS, "markov"]])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(docs: DataFrame, mark: str = "[SECRET]", **params) -> DataFrame:
    """``docs`` with every span of the scan replaced by ``mark``; other columns unchanged but
    n_chars, which is the new text's length."""
    own, name = positional(docs)
    d = scan(own.withColumn("text", F.col(name["text"])), train(docs.select("doc_id", "text")), **params)
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    body = F.aggregate(
        "spans", zero,
        lambda acc, x: F.when(x["start"] < acc["at"], F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"), acc["out"].alias("out"))).otherwise(F.struct(
                x["end"].alias("at"),
                F.concat(acc["out"], F.substring("text", acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark)).alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    found = F.size("spans") > 0
    d = d.withColumn(name["text"], F.when(found, body).otherwise(F.col(name["text"])))
    if "n_chars" in name:
        d = d.withColumn(name["n_chars"], F.when(found, F.length(name["text"]).cast(docs.schema["n_chars"].dataType))
                         .otherwise(F.col(name["n_chars"])))
    return d.select(*own.columns).toDF(*docs.columns)


def op7_secrets(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    d = scan(docs, train(docs)).select("doc_id", "base", "spans")
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return d.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                    F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
