"""Hot-deal quality report on landed records (Q-00), in long format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import round_half_up, safe_div
from ..operators.quantiles import group_quantiles


def hot_deal_quality(silver: DataFrame, min_discount: float = 20, max_discount: float = 70) -> DataFrame:
    """Invalid prices, no-discount rows, a right-closed discount histogram
    (min-30, 30-50, 50-max, max+) and per-store average discount of hot deals."""
    d = silver.where(F.col("price").isNotNull() & F.col("list_price").isNotNull()).select(
        F.col("supermarket").alias("store"), "price", "list_price",
        (safe_div(F.col("list_price") - F.col("price"), "list_price") * 100).alias("d"))
    h = d.where(F.col("d") >= min_discount)
    dd = F.col("d")
    band = (F.when(dd <= 30, f"{int(min_discount)}-30%").when(dd <= 50, "30-50%")
             .when(dd <= max_discount, f"50-{int(max_discount)}%").otherwise(f"{int(max_discount)}%+"))
    null_d = F.lit(None).cast("double")
    null_s = F.lit(None).cast("string")
    parts = [
        d.where(F.col("price") > F.col("list_price")).agg(F.lit("invalid_price").alias("section"),
                                                          null_s.alias("label"), F.count(F.lit(1)).alias("n"),
                                                          null_d.alias("value")),
        d.where(F.col("price") == F.col("list_price")).agg(F.lit("no_discount").alias("section"),
                                                           null_s.alias("label"), F.count(F.lit(1)).alias("n"),
                                                           null_d.alias("value")),
        h.groupBy(band.alias("label")).agg(F.count(F.lit(1)).alias("n"))
         .select(F.lit("histogram").alias("section"), "label", "n", null_d.alias("value")),
        h.groupBy(F.col("store").alias("label")).agg(F.count(F.lit(1)).alias("n"),
                                                    round_half_up(F.avg("d"), 1).alias("value"))
         .select(F.lit("by_store").alias("section"), "label", "n", "value"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def suspicious_top(silver: DataFrame, n: int = 10, max_discount: float = 70) -> DataFrame:
    """The n largest discounts above ``max_discount`` (nlargest, with a tie-break)."""
    d = silver.select("supermarket", "sku", "name", "price", "list_price", "region", "collected_at",
                      (safe_div(F.col("list_price") - F.col("price"), "list_price") * 100).alias("discount_pct"))
    top = (d.where(F.col("discount_pct") > max_discount)
            .orderBy(F.col("discount_pct").desc(), "sku", "supermarket", "region", "collected_at").limit(n))
    return top.drop("region", "collected_at")


def json_report(silver: DataFrame, generated_at, min_discount: float = 20, max_discount: float = 70) -> DataFrame:
    """SNK-08: the hot-deal quality report as one row of nested structs: parameters, summary,
    quality, by_store (as many entries as stores)."""
    pct = safe_div(F.col("list_price") - F.col("price"), "list_price") * 100
    d = silver.select(F.col("supermarket").alias("store"), "price", "list_price",
                      (F.col("price").isNotNull() & F.col("list_price").isNotNull()).alias("priced")).withColumn("pct", F.when(F.col("priced"), pct))
    hot = F.col("pct") >= min_discount
    units = F.when(hot, F.round(F.col("pct") * 1_000_000).cast("bigint"))   # whole numbers: the sum has no order
    mean = lambda: F.sum(units).cast("double") / F.count(units) / 1e6
    stores = d.groupBy("store").agg(F.count_if(hot).alias("count"), round_half_up(mean(), 1).alias("avg_discount"),
                                    round_half_up(F.max(F.when(hot, F.col("pct"))), 1).alias("max_discount"))
    by_store = stores.where("count > 0").agg(F.sort_array(F.collect_list(F.struct("store", "count", "avg_discount", "max_discount"))).alias("by_store"))
    whole = d.agg(
        F.count(F.lit(1)).alias("total_products"), F.count_if("priced").alias("products_with_pricing"),
        F.count_if(hot).alias("total_hot_deals"), round_half_up(mean(), 4).alias("average_discount"),
        round_half_up(F.max(F.when(hot, F.col("pct"))), 4).alias("max_discount"),
        F.count_if(F.col("price") > F.col("list_price")).alias("invalid_pricing_count"),
        F.count_if(F.col("pct") > max_discount).alias("suspicious_deals_count"))
    half = group_quantiles(d.where(hot).withColumn("_one", F.lit(1)), ["_one"], "pct", {"median_discount": 0.5})
    one = lambda df: df.withColumn("_k", F.lit(1))
    j = one(whole).join(one(by_store), "_k").join(half.select(F.col("_one").alias("_k"), round_half_up(F.col("median_discount"), 4)
                                                             .alias("median_discount")), "_k", "left")
    share = round_half_up(F.col("total_hot_deals") / F.greatest("products_with_pricing", F.lit(1)) * 100, 4)
    return j.select(
        F.lit(generated_at.isoformat()).alias("generated_at"),
        F.struct(F.lit(float(min_discount)).alias("min_discount"), F.lit(float(max_discount)).alias("max_discount")).alias("parameters"),
        F.struct("total_products", "products_with_pricing", "total_hot_deals", share.alias("hot_deals_percentage"),
                 "average_discount", "median_discount", "max_discount").alias("summary"),
        F.struct("invalid_pricing_count", "suspicious_deals_count").alias("quality"), "by_store")
