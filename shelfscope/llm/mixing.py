"""Mixing sources to target weights with Efraimidis-Spirakis sampling.

Every source gets a target share of all words by weight, held at a multiple of its own size,
the excess reshared. A source then runs through as many complete epochs as its target holds;
what is left of the target is filled with documents in the order of exponential keys scaled
by a quality weight (-ln(u) / w, u from a hash of the document): weighted sampling without
replacement, prefix-summed up to the budget. Documents larger than the gap that is left are
passed over and the prefix sum goes on with the others, until none fits; that is each
document in turn, taken if it fits. The last gap is closed by the one further document whose
size comes nearest to it.

The prefix sum is distributed: keys fall into buckets that keep their order, buckets are
summed, and only rows of one bucket (about ``bucket_rows``) are sorted together, so a source
that holds a third of all rows is spread like the rest. Only the table of sources (a row
each) is ordered in one task.

Defined results: null text has size 0; null sources are one source, last in order; a source
of size 0 has target 0; ties in the key go by doc_id and size; repeated rows draw the same
key and are taken one after the other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, n_words, positional, written

SYMBOLS = "#*$%&|<>"


def quality_weight(text: Column) -> Column:
    """1 for plain prose, down to 1/4 where symbols abound."""
    t = F.coalesce(text, F.lit(""))
    share = (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))) / F.greatest(F.length(t), F.lit(1))
    return F.greatest(F.lit(0.25), 1 - 4 * share)


def source_targets(sizes: DataFrame, weights: tuple = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """(source, source_size, n_docs, target): the shares of all words by repeating weights in
    source order, none above ``most`` times the source's size.

    Sharing again what capped sources leave ends where the uncapped ones stand at one common
    level per weight; in the order of cap / weight those below that level come first.
    """
    one = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    one = one.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    every = Window.partitionBy(F.lit(1))
    by = Window.partitionBy(F.lit(1)).orderBy((F.col("cap") / F.col("w")), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    capped = F.col("cap") * F.sum("w").over(after) <= left * F.col("w")
    one = one.withColumn("capped", capped)
    free = F.sum("source_size").over(every) - F.coalesce(
        F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0.0))
    level = free / F.sum(F.when(~F.col("capped"), F.col("w"))).over(every)
    return one.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * level)).select(
        "source", "source_size", "n_docs", "target")


def mix(docs: DataFrame, weights: tuple = (5, 2, 1), most: float = 3.0, seed: int = 20,
        weight: Column | None = None, bucket_rows: int = 512) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every document: how
    often the mix takes it whole, and the words that makes."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11) + 0.5) / F.lit(float(1 << 53))
    sizes = written(
        docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                    (-F.log(u) / (quality_weight(F.col("text")) if weight is None else weight)).alias("key")),
        "mix-sizes")
    plan = source_targets(sizes, weights, most).select(
        F.col("source").alias("_source"), "source_size", "target",
        F.ceil(F.col("n_docs") / bucket_rows).alias("_nb"),
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        .cast("int").alias("epochs"))
    d = sizes.join(plan, sizes["source"].eqNullSafe(plan["_source"])).withColumn(
        "bucket", F.floor(F.col("_nb") * (F.col("key") / (1 + F.col("key")))))
    order = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
    own = order.rowsBetween(Window.unboundedPreceding, 0)
    sums = d.groupBy("source", "bucket").agg(F.sum("size").alias("_s"))
    sums = sums.select(F.col("source").alias("_bs"), F.col("bucket").alias("_bb"), F.coalesce(F.sum("_s").over(
        Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_before"))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    d = written(
        d.withColumn("_in", F.sum("size").over(own)).withColumn("place", F.row_number().over(order))
        .join(sums, F.col("source").eqNullSafe(F.col("_bs")) & (F.col("bucket") == F.col("_bb")))
        .withColumn("picked", (F.col("_before") + F.col("_in") <= rest) & (F.col("size") > 0))
        .select("doc_id", "source", "size", "source_size", "target", "epochs", "key", "bucket", "place", "picked"),
        "mix-picked")
    gap = d.groupBy("source").agg(F.max(rest).alias("_rest"), F.sum(F.when(F.col("picked"), F.col("size"))).alias("_got"))
    gap = gap.select(F.col("source").alias("_gs"), (F.col("_rest") - F.coalesce("_got", F.lit(0))).alias("_gap"))
    gap, more = filled(d.where(~F.col("picked")).select("source", "size", "bucket", "place"), gap)
    more = more.select(F.col("source").alias("_ms"), F.col("bucket").alias("_mb"), F.col("place").alias("_mp"))
    d = written(d.join(more, F.col("source").eqNullSafe(F.col("_ms")) & (F.col("bucket") == F.col("_mb"))
                       & (F.col("place") == F.col("_mp")), "left")
                .withColumn("picked", F.col("picked") | F.col("_mp").isNotNull()).drop("_ms", "_mb", "_mp"), "mix-filled")
    # one more document a source, the one that comes nearest to what is still open
    miss = F.abs(F.col("_gap") - F.col("size"))
    last = (d.where(~F.col("picked")).join(gap, F.col("source").eqNullSafe(F.col("_gs"))).where(miss < F.col("_gap"))
            .groupBy(F.col("source").alias("_ls"))
            .agg(F.min(F.struct(miss.alias("miss"), "key", "bucket", "place")).alias("_l")))
    d = d.join(last, F.col("source").eqNullSafe(F.col("_ls")), "left")
    extra = F.coalesce((F.col("bucket") == F.col("_l.bucket")) & (F.col("place") == F.col("_l.place")), F.lit(False))
    return d.withColumn("copies", F.col("epochs") + (F.col("picked") | extra).cast("int")).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def filled(open_: DataFrame, gap: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gap, picked): what stays open of every source's ``gap`` (_gs, _gap), and the rows of
    ``open_`` (source, size, bucket, place) that fill it, in order of bucket and place, each if
    it fits what those before it left. A round passes over the rows larger than the gap and
    takes the others up to the first that crosses it, so it takes one row at least."""
    here = F.col("source").eqNullSafe(F.col("_gs"))
    gap = written(gap, "mix-gap")
    picked = []
    while True:
        left = written(open_.join(gap, here).where((F.col("size") > 0) & (F.col("size") <= F.col("_gap")))
                       .drop("_gs"), "mix-open")
        if left.isEmpty():
            break
        own = Window.partitionBy("source", "bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = left.groupBy("source", "bucket").agg(F.sum("size").alias("_s"))
        sums = sums.select(F.col("source").alias("_bs"), F.col("bucket").alias("_bb"),
                           F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"))
        left = written(
            left.withColumn("_in", F.sum("size").over(own))
            .join(sums, F.col("source").eqNullSafe(F.col("_bs")) & (F.col("bucket") == F.col("_bb")))
            .withColumn("took", F.col("_before") + F.col("_in") <= F.col("_gap"))
            .select("source", "size", "bucket", "place", "took"), "mix-round")
        picked.append(left.where("took").drop("took"))
        open_ = left.where("not took").drop("took")
        got = picked[-1].groupBy(F.col("source").alias("_ps")).agg(F.sum("size").alias("_got"))
        gap = written(gap.join(got, F.col("_gs").eqNullSafe(F.col("_ps")), "left").select(
            "_gs", (F.col("_gap") - F.coalesce("_got", F.lit(0))).alias("_gap")), "mix-gap")
    more = open_.limit(0)
    for p in picked:
        more = more.unionByName(p)
    return gap, more


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, columns unchanged."""
    n = mix(docs, **params).groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_src")).agg(
        F.max("copies").alias("_copies"))  # rows that share an id and a source go together
    d, name = positional(docs)
    return (d.join(n.where("_copies > 0"), F.col(name["doc_id"]).eqNullSafe(F.col("_id"))
                   & F.col(name["source"]).eqNullSafe(F.col("_src")))
            .withColumn("_k", F.explode(F.expr("sequence(1, _copies)")))
            .select(*d.columns).toDF(*docs.columns))


def op2_mixing(spark, sf_dir):
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
