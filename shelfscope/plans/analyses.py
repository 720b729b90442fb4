"""Location analyses (L-01 .. L-07) and KPI queries (K-01, K-03 .. K-08)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.columns import money_avg, pct, round_half_up, snap


def priced_locations(daily: DataFrame, dim_region: DataFrame, dim_location: DataFrame,
                     dim_store: DataFrame) -> DataFrame:
    """Daily prices with location and store names (dimensions are small; Spark
    broadcasts them by measured size)."""
    r = dim_region.select("region_key", F.col("region_code").alias("location_id"))
    loc = dim_location.select("location_id", "location_key", "city_name", "neighborhood_name", "state_code",
                              "latitude", "longitude")
    s = F.broadcast(dim_store.select("store_key", "store_name"))  # 5-row seed
    return (daily.where(F.col("min_price") > 0)
                 .select("product_key", "product_id", "product_name", "store_key", "region_key", "scraped_date",
                         "min_price")
                 .join(r, "region_key").join(loc, "location_id").join(s, "store_key"))


def l01_location_rank(pl: DataFrame, location_id: str) -> DataFrame:
    g = (pl.where(F.col("location_id") == location_id)
           .groupBy("product_name", "city_name", "neighborhood_name", "store_name")
           .agg(round_half_up(money_avg("min_price"), 2).alias("avg_price")))
    w = Window.partitionBy("product_name").orderBy("avg_price")  # stores per product: bounded
    return g.select("product_name",
                    F.concat(F.col("city_name"), F.lit(" - "), F.col("neighborhood_name")).alias("location"),
                    "store_name", "avg_price", F.rank().over(w).cast("bigint").alias("price_rank"))


def l02_coverage_gap(dim_location: DataFrame, dim_store: DataFrame, bridge: DataFrame) -> DataFrame:
    """Every location x store pair with its presence. The store side is the
    5-row seed, broadcast; the pair count is locations x stores by definition."""
    stores = F.broadcast(dim_store.select("store_key", "store_name").withColumn("_k", F.lit(1)))
    pairs = dim_location.select("location_key", "city_name", "neighborhood_name").withColumn("_k", F.lit(1)) \
        .join(stores, "_k").drop("_k")
    b = bridge.select("location_key", "store_key", "store_location_key")
    j = pairs.join(b, ["location_key", "store_key"], "left")
    return j.select("city_name", "neighborhood_name", "store_name",
                    F.when(F.col("store_location_key").isNull(), config.COVERAGE_ABSENT)
                     .otherwise(config.COVERAGE_PRESENT).alias("status"))


def l03_heat_map(pl: DataFrame, limit: int = 50) -> DataFrame:
    g = pl.groupBy("city_name", "neighborhood_name", "state_code", "latitude", "longitude").agg(
        F.count_distinct("product_key").alias("products"),
        round_half_up(money_avg("min_price"), 2).alias("avg_price"),
        round_half_up(F.min("min_price"), 2).alias("min_price"),
        round_half_up(F.max("min_price"), 2).alias("max_price"))
    return g.orderBy(F.col("avg_price").desc(), "city_name", "neighborhood_name").limit(limit)


def _store_list(sep: str):
    names = F.array_sort(F.collect_set("store_name"))  # bounded by the number of stores
    return F.when(F.size(names) > 0, F.array_join(names, sep))


def l04_store_density(dim_location: DataFrame, bridge: DataFrame, dim_store: DataFrame) -> DataFrame:
    s = F.broadcast(dim_store.select("store_key", "store_name"))
    j = (dim_location.select("location_key", "city_name", "state_code")
         .join(bridge.select(F.col("location_key"), "store_key", F.col("location_key").alias("_lk")),
               "location_key", "left")
         .join(s, "store_key", "left"))
    return j.groupBy("city_name", "state_code").agg(
        F.size(F.collect_set("store_key")).cast("bigint").alias("total_stores"),
        _store_list(", ").alias("stores_present"),
        F.size(F.collect_set("_lk")).cast("bigint").alias("total_locations"))


def l05_competition(dim_location: DataFrame, bridge: DataFrame, dim_store: DataFrame) -> DataFrame:
    s = F.broadcast(dim_store.select("store_key", "store_name"))
    j = (dim_location.select("location_key", "location_id", "city_name", "neighborhood_name")
         .join(bridge.select("location_key", "store_key"), "location_key").join(s, "store_key"))
    g = j.groupBy("location_id", "city_name", "neighborhood_name").agg(
        F.size(F.collect_set("store_key")).cast("bigint").alias("competing_stores"),
        _store_list(" vs ").alias("competitors"))
    n = F.col("competing_stores")
    level = None
    for threshold, label in config.COMPETITION_LEVELS:
        cond = n >= threshold if threshold == config.COMPETITION_LEVELS[0][0] else n == threshold
        level = F.when(cond, label) if level is None else level.when(cond, label)
    return g.select("city_name", "neighborhood_name", "competing_stores", "competitors",
                    level.otherwise(config.COMPETITION_OTHER).alias("competition_level"))


def l06_city_variation(pl: DataFrame, min_spread: float = 20, limit: int = 100) -> DataFrame:
    nb = (pl.groupBy("city_name", "neighborhood_name", "product_name")
            .agg(round_half_up(money_avg("min_price"), 2).alias("avg_price")))
    st = (nb.groupBy("city_name", "product_name")
            .agg(F.min("avg_price").alias("cheapest_neighborhood_price"),
                 F.max("avg_price").alias("most_expensive_neighborhood_price"),
                 F.count_distinct("neighborhood_name").alias("_n"))
            .where(F.col("_n") >= 2).drop("_n"))
    st = st.withColumn("price_spread_pct", pct(F.col("most_expensive_neighborhood_price")
                                               - F.col("cheapest_neighborhood_price"),
                                               "cheapest_neighborhood_price", 1))
    return (st.where(F.col("price_spread_pct") > min_spread)
              .orderBy(F.col("price_spread_pct").desc(), "city_name", "product_name").limit(limit))


def location_store_prices(pl: DataFrame) -> DataFrame:
    """WIN-08: aggregate per location x store, then rank the aggregate within the location."""
    g = pl.groupBy("location_id", "neighborhood_name", "store_name").agg(money_avg("min_price").alias("avg_price"))
    w = Window.partitionBy("location_id").orderBy("avg_price")  # stores per location: bounded
    return g.withColumn("price_rank", F.rank().over(w).cast("bigint"))


def l07_no_cheap_store(pl: DataFrame, threshold: float = 25.0) -> DataFrame:
    lp = location_store_prices(pl)
    return (lp.groupBy("neighborhood_name")
              .agg(F.size(F.collect_set("store_name")).cast("bigint").alias("stores_in_area"),
                   F.min("avg_price").alias("cheapest_store_avg"),
                   F.max("avg_price").alias("most_expensive_store_avg"))
              .where(F.col("cheapest_store_avg") > threshold))


# ------------------------------------------------------------------- KPIs
def k01_pricing_catalog(tru: DataFrame) -> DataFrame:
    p = F.col("min_price")
    g = tru.where(p.isNotNull()).groupBy("supermarket").agg(
        money_avg(p).alias("avg_price"),
        snap(F.stddev_samp(p) / money_avg(p)).alias("price_volatility"),
        F.count_distinct("product_id").alias("catalog_size"),
        pct(F.count_if("is_available"), F.count(F.lit(1))).alias("availability_rate_pct"),
        F.avg("sku_count").alias("avg_sku_count"),
    )
    w = Window.orderBy("avg_price")  # over the per-store result
    return g.select("*", F.rank().over(w).cast("bigint").alias("competitiveness_rank"))


def k03_most_competitive(daily: DataFrame, day: dt.date) -> DataFrame:
    d = daily.where(F.col("scraped_date") == F.lit(day)).select("product_id", "supermarket", "min_price")
    w = Window.partitionBy("product_id").orderBy("min_price")  # stores x regions per product-day: bounded
    r = d.withColumn("price_rank", F.rank().over(w))
    return r.where(F.col("price_rank") == 1).groupBy("supermarket").agg(
        F.count(F.lit(1)).alias("competitive_products_count"))


def k04_top_recommended(hd: DataFrame, day: dt.date, limit: int = 10) -> DataFrame:
    return (hd.where((F.col("scraped_date") == F.lit(day)) & F.col("is_recommended_deal"))
              .orderBy("overall_rank", "store_key", "region_key", "product_key")
              .select("product_name", "brand", "supermarket", "region", "promotional_price", "regular_price",
                      "discount_percentage", "quality_score", "legitimacy_level", "overall_rank")
              .limit(limit))


def k04_suspicious_by_priority(susp: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    s = susp.where(F.col("scraped_date") >= F.lit(as_of - dt.timedelta(days=days)))
    return s.groupBy("review_priority").agg(
        F.count(F.lit(1)).alias("deals_count"),
        money_avg("discount_percentage").alias("avg_discount"),
        F.avg("quality_score").alias("avg_quality_score"))


def k04_flash_deals(hd: DataFrame, limit: int = 20) -> DataFrame:
    return (hd.where(F.col("is_flash_deal") & (F.col("discount_percentage") > 50))
              .orderBy(F.col("discount_percentage").desc(), "product_key", "store_key", "region_key", "date_key")
              .select("product_name", "supermarket", "region", "scraped_date", "deal_persistence_days",
                      "discount_percentage", "quality_score", "legitimacy_level")
              .limit(limit))


def k04_store_quality(hd: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    h = hd.where(F.col("scraped_date") >= F.lit(as_of - dt.timedelta(days=days)))
    return h.groupBy("supermarket").agg(
        F.count(F.lit(1)).alias("total_hot_deals"),
        F.count_if("is_recommended_deal").alias("recommended_deals"),
        F.count_if(F.col("legitimacy_level") == "Suspicious").alias("suspicious_deals"),
        F.avg("quality_score").alias("avg_quality_score"),
        money_avg("discount_percentage").alias("avg_discount"))


def k05_alerts(hd: DataFrame) -> DataFrame:
    """Per day: suspicious ratio, average score, flash and invalid counts, alert level."""
    g = hd.groupBy("scraped_date").agg(
        F.count(F.lit(1)).alias("deals"),
        F.count_if("is_suspicious_discount").alias("suspicious_deals"),
        F.avg("quality_score").alias("avg_quality_score"),
        F.count_if(F.col("is_flash_deal") & (F.col("discount_percentage") > 50)).alias("flash_deals"),
        F.count_if("has_invalid_price").alias("invalid_prices"))
    ratio = F.col("suspicious_deals") / F.col("deals")
    level = (F.when(F.col("suspicious_deals") > 50, "CRITICAL").when(F.col("avg_quality_score") < 50, "WARNING")
              .when(F.col("flash_deals") > 100, "INFO").otherwise("OK"))
    return g.select("*", ratio.alias("suspicious_ratio"), (ratio < 0.10).alias("suspicious_ratio_ok"),
                    (F.col("avg_quality_score") > 60).alias("quality_ok"), level.alias("alert_level"))


def k06_enrichment_by_store(daily: DataFrame, dim_ean: DataFrame) -> DataFrame:
    e = dim_ean.select("ean_key", "is_enriched")
    j = daily.select("supermarket", "product_id", "ean_key").join(e, "ean_key", "left")
    g = j.groupBy("supermarket").agg(
        F.count_distinct("product_id").alias("products"),
        F.count_distinct(F.when(F.col("ean_key").isNotNull(), F.col("product_id"))).alias("products_with_ean"),
        F.count_distinct(F.when(F.col("is_enriched"), F.col("product_id"))).alias("enriched_products"))
    return g.withColumn("coverage_pct", pct("enriched_products", "products_with_ean"))


def k06_grade_distribution(dim_ean: DataFrame) -> DataFrame:
    return dim_ean.groupBy("nutrition_quality").agg(
        F.count(F.lit(1)).alias("barcodes"), F.count_if("is_enriched").alias("enriched"))


WEIGHT_RE = r"([0-9.,]+)\s*(kg|g|ml|l)\b"


def k07_price_per_kg(daily: DataFrame, dim_ean: DataFrame) -> DataFrame:
    """Price per kg (or litre) from the reference record's net weight text."""
    w = F.lower(F.col("net_weight"))
    qty = F.regexp_replace(F.regexp_extract(w, WEIGHT_RE, 1), ",", ".").try_cast("double")
    unit = F.regexp_extract(w, WEIGHT_RE, 2)
    kg = F.when(unit.isin("kg", "l"), qty).when(unit.isin("g", "ml"), qty / 1000)
    e = dim_ean.where(F.col("is_enriched")).select("ean_key", "net_weight", kg.alias("weight_kg"))
    j = daily.select("product_id", "supermarket", "region", "scraped_date", "ean_key", "min_price").join(e, "ean_key")
    j = j.where(F.col("weight_kg") > 0)
    return j.select("product_id", "supermarket", "region", "scraped_date", "net_weight", "weight_kg", "min_price",
                    round_half_up(F.col("min_price") / F.col("weight_kg"), 2).alias("price_per_kg"))


def k08_serving_table(daily: DataFrame, dim_product: DataFrame, dim_store: DataFrame, as_of: dt.date,
                      days: int = 90) -> DataFrame:
    """Wide serving table with a price category (documented serving layer)."""
    p = dim_product.select("product_id", F.col("product_name").alias("dim_product_name"), F.col("brand").alias("dim_brand"))
    s = F.broadcast(dim_store.select(F.col("store_id").alias("supermarket"), "store_name"))
    d = daily.where(F.col("scraped_date") >= F.lit(as_of - dt.timedelta(days=days)))
    j = d.select("product_id", "supermarket", "region", "scraped_date", "min_price", "is_available") \
         .join(p, "product_id").join(s, "supermarket")
    cat = None
    for threshold, label in config.PRICE_CATEGORIES:
        cat = F.when(F.col("min_price") < threshold, label) if cat is None else cat.when(F.col("min_price") < threshold, label)
    return j.select(F.col("dim_product_name").alias("product_name"), F.col("dim_brand").alias("brand"),
                    F.col("store_name").alias("supermarket"), "region", F.col("scraped_date").alias("date"),
                    F.col("min_price").alias("price"), F.col("is_available").alias("in_stock"),
                    cat.otherwise(config.PRICE_CATEGORY_OTHER).alias("price_category"))


def k06_same_barcode_across_stores(daily: DataFrame, dim_ean: DataFrame) -> DataFrame:
    """K-06: enriched barcodes sold by 2+ stores, with their price range."""
    e = dim_ean.select("ean_key", "ean_code", "canonical_name", "is_enriched")
    j = daily.select("ean_key", "supermarket", "min_price").join(e, "ean_key")
    g = j.groupBy("ean_code", "canonical_name", "is_enriched").agg(
        F.size(F.collect_set("supermarket")).cast("bigint").alias("stores"),  # bounded by the stores
        F.min("min_price").alias("lowest_price"), F.max("min_price").alias("highest_price"))
    return g.where(F.col("stores") >= 2)
