"""Analytics over the landed records: silver view, snapshot, reports (R-00 .. R-09).

Decisions (README): the snapshot keeps the latest collection *day* per store x
region (the reference's per-batch timestamp keeps only the last batch); the
competitiveness basket prices each barcode once per store (its lowest price)
before summing, and keeps the reference's row-sum as ``*_raw``; ties in
arg-min/arg-max and top-k carry explicit tie-breaks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import money_units, money_avg, round_half_up, strip_leading_zeros


def silver_products(bronze: DataFrame) -> DataFrame:
    """SRC-05: one flat row per landed record: first SKU, first seller."""
    item = F.get(F.col("items"), 0)
    offer = F.get(item["sellers"], 0)["commertialOffer"]
    supermarket = F.coalesce(F.nullif(F.col("_metadata_supermarket"), F.lit("")), F.lit("unknown"))
    s = bronze.select(
        F.col("_metadata_scraped_at").try_cast("timestamp").alias("collected_at"),
        F.col("_metadata_region").alias("region"),
        supermarket.alias("supermarket"),
        F.col("productId").alias("sku"),
        F.col("productName").alias("name"),
        "brand",
        item["ean"].alias("ean_raw"),
        offer["Price"].try_cast("double").alias("price"),
        offer["ListPrice"].try_cast("double").alias("list_price"),
        offer["AvailableQuantity"].try_cast("int").alias("stock"),
    )
    return (s.select("collected_at", "region", "supermarket", "sku", "name", "brand",
                     strip_leading_zeros("ean_raw").alias("ean"), "price", "list_price", "stock")
             .where(F.col("price") > 0))


def build_snapshot(silver: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """R-00: latest collection day per store x region within ``days`` of ``as_of``."""
    since = F.lit(as_of - dt.timedelta(days=days)).cast("timestamp")
    recent = silver.where(F.col("collected_at") >= since).withColumn("_day", F.to_date("collected_at"))
    # one row per store x region: bounded by configuration
    latest = recent.groupBy("supermarket", "region").agg(F.max("_day").alias("_day"))
    snap = recent.join(latest, ["supermarket", "region", "_day"], "left_semi")
    return (snap.where((F.col("price") > 0) & F.col("ean").isNotNull() & (F.col("ean") != ""))
                .select("supermarket", "region", "sku", "name", "brand", "price", "list_price", "stock",
                        "collected_at", "ean"))


def r01_scorecard(snap: DataFrame) -> DataFrame:
    return snap.groupBy("supermarket").agg(
        F.count_distinct("ean").alias("product_mix"),
        round_half_up(money_avg("price"), 2).alias("avg_ticket"),
        F.size(F.collect_set("region")).cast("bigint").alias("regions_monitored"),
        F.max("collected_at").alias("last_update"),
    )


def r02_competitiveness(snap: DataFrame) -> DataFrame:
    common = (snap.groupBy("ean").agg(F.size(F.collect_set("supermarket")).alias("_n"))
                  .where(F.col("_n") >= 2).select("ean"))
    rows = snap.join(common, "ean", "left_semi")
    # one price per barcode per store (its lowest) — and the reference's row sum as *_raw
    per_ean = rows.groupBy("supermarket", "ean").agg(
        F.min("price").alias("price"), F.sum(money_units("price")).alias("_raw_cents"))
    basket = per_ean.groupBy("supermarket").agg(
        F.count(F.lit(1)).alias("comparable_items"),
        (F.sum(money_units("price")).cast("double") / 10000.0).alias("basket_cost"),
        (F.sum("_raw_cents").cast("double") / 10000.0).alias("basket_cost_raw"),
    )
    allw = Window.partitionBy()  # over the per-store result: one row per store
    return basket.select(
        "supermarket", "comparable_items",
        round_half_up("basket_cost", 2).alias("basket_cost"),
        round_half_up(F.col("basket_cost") / F.min("basket_cost").over(allw) * 100, 1).alias("price_index"),
        round_half_up("basket_cost_raw", 2).alias("basket_cost_raw"),
        round_half_up(F.col("basket_cost_raw") / F.min("basket_cost_raw").over(allw) * 100, 1)
         .alias("price_index_raw"),
    )


def r03_recent_drops(silver: DataFrame, snap: DataFrame, as_of: dt.date, limit: int = 100) -> DataFrame:
    lo = F.lit(as_of - dt.timedelta(days=7)).cast("timestamp")
    hi = F.lit(as_of - dt.timedelta(days=3)).cast("timestamp")
    hist = silver.where(F.col("collected_at").between(lo, hi))
    from ..operators.dedup import latest_per_key
    hist = latest_per_key(hist, ["supermarket", "ean"], ["collected_at", "sku", "region"], keep=["price"])
    hist = hist.select("supermarket", strip_leading_zeros("ean").alias("_ean"), F.col("price").alias("old_price"))
    j = snap.join(hist, (snap.supermarket == hist.supermarket) & (snap.ean == hist._ean)).drop(hist.supermarket)
    drop = (F.col("old_price") - F.col("price")) / F.col("old_price")
    j = j.where((F.col("price") < F.col("old_price")) & (drop >= 0.10))
    out = j.select("supermarket", "region", "sku", F.col("name").alias("product"), "old_price",
                   F.col("price").alias("new_price"), round_half_up(drop * 100, 1).alias("discount_pct"))
    return out.orderBy(F.col("discount_pct").desc(), "supermarket", "region", "sku").limit(limit)


def r04_arbitrage(snap: DataFrame, limit: int | None = None) -> DataFrame:
    """Price gaps over 30 % between stores, all of them unless the caller wants a top-k."""
    g = snap.groupBy("ean").agg(
        F.min("name").alias("product"),
        F.min_by("supermarket", F.struct("price", "supermarket")).alias("cheapest_store"),
        F.min("price").alias("min_price"),
        F.max_by("supermarket", F.struct("price", "supermarket")).alias("priciest_store"),
        F.max("price").alias("max_price"),
        F.size(F.collect_set("supermarket")).alias("_stores"),
    )
    g = g.withColumn("gap_pct", round_half_up((F.col("max_price") - F.col("min_price")) / F.col("min_price") * 100, 1))
    g = g.where((F.col("_stores") >= 2) & (F.col("gap_pct") > 30)).drop("_stores")
    return g if limit is None else g.orderBy(F.col("gap_pct").desc(), "ean").limit(limit)


def r05_price_bands(snap: DataFrame) -> DataFrame:
    p = F.col("price")
    return snap.groupBy("supermarket").agg(
        F.count_if(p <= 10).alias("up_to_10"),
        F.count_if((p > 10) & (p <= 30)).alias("from_10_to_30"),
        F.count_if(p > 30).alias("above_30"),
        round_half_up(money_avg("price"), 2).alias("avg_price"),
    )


def r06_volume_audit(silver: DataFrame, as_of: dt.date) -> DataFrame:
    since = F.lit(as_of - dt.timedelta(days=7)).cast("timestamp")
    return (silver.where(F.col("collected_at") >= since)
                  .groupBy("supermarket", F.to_date("collected_at").alias("day"), "region")
                  .agg(F.count(F.lit(1)).alias("volume"))
                  .orderBy(F.col("day").desc(), F.col("volume").desc(), "supermarket", "region"))


def r07_stats(silver: DataFrame) -> DataFrame:
    return silver.groupBy("supermarket").agg(
        F.size(F.collect_set("region")).cast("bigint").alias("regions"),
        F.count_distinct("sku").alias("products"),
        round_half_up(money_avg("price"), 2).alias("avg_price"),
        F.min("collected_at").alias("first_collection"),
        F.max("collected_at").alias("last_collection"),
    )


def register_views(spark: SparkSession, silver: DataFrame, snap: DataFrame) -> None:
    silver.createOrReplaceTempView("silver_products")
    snap.createOrReplaceTempView("snapshot")


def query(spark: SparkSession, sql: str) -> DataFrame:
    """R-08: ad-hoc SQL over the registered views (Catalyst plans it like any DataFrame)."""
    return spark.sql(sql)
