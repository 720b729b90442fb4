"""Fact models and views (M-12 .. M-21)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..config import DEFAULT, Params
from ..functions.columns import money_units, first_of, money_avg, money_sum, pct, round_half_up, snap
from ..operators.keys import ranks_within_groups
from ..operators.quantiles import group_quantiles


# ---------------------------------------------------------------- M-12
def fct_daily_prices(tru: DataFrame, dim_product: DataFrame, dim_store: DataFrame,
                     dim_region: DataFrame, dim_date: DataFrame, dim_brand: DataFrame,
                     dim_ean: DataFrame) -> DataFrame:
    """Star join of the trusted rows to six dimensions.

    dim_store is a 5-row seed (broadcast). The other dimensions grow with the
    data; they are plain equi-joins so Spark broadcasts them only when their
    measured size is under the broadcast threshold (AQE re-checks at runtime)
    and otherwise shuffles — no unchecked broadcast. The two that grow with the
    products (whose packed files look smaller than their rows are) are merged with
    the distinct pairs of product and barcode first, so
    the wide rows are shuffled once for both. One row per trusted row:
    every dimension is unique on its join key (dim_region has one row per code).
    """
    p = tru.withColumn("_ean1", first_of("eans"))
    pairs = (p.select(F.col("product_id").alias("_product"), F.col("_ean1").alias("_code")).distinct()
              .join(dim_product.select(F.col("product_id").alias("_product"), "product_key").hint("merge"), "_product")
              .join(dim_ean.select(F.col("ean_code").alias("_code"), "ean_key").hint("merge"), "_code", "left"))
    j = (p.join(pairs, (F.col("product_id") == F.col("_product")) & F.col("_ean1").eqNullSafe(F.col("_code")))
          .join(F.broadcast(dim_store.select(F.col("store_id").alias("supermarket"), "store_key")), "supermarket")
          .join(dim_region.select(F.col("region_code").alias("region"), "region_key"), "region")
          .join(dim_date.select(F.col("date_day").alias("scraped_date"), "date_key"), "scraped_date")
          .join(dim_brand.select(F.col("brand_name").alias("brand"), "brand_key"), "brand", "left"))
    lp, pr = F.col("min_list_price"), F.col("min_price")
    return j.select(
        "scraped_date", "product_key", "store_key", "region_key", "date_key", "brand_key", "ean_key",
        "product_id", "product_name", "supermarket", "region", "brand",
        "min_price", "max_price", "avg_price", "min_list_price",
        (F.col("max_price") - pr).alias("price_range"),
        F.when((lp > 0) & (pr > 0), round_half_up((lp - pr) / lp * 100, 2)).otherwise(F.lit(0.0))
         .alias("discount_pct"),
        "sku_count", "is_available", "total_available_quantity", "run_id", "scraped_at",
    )


# ---------------------------------------------------------------- M-13
def promotion_type(d) -> F.Column:
    e = None
    for threshold, label in config.PROMOTION_TYPES:
        e = (F.when(d >= threshold, label) if e is None else e.when(d >= threshold, label))
    return e.otherwise(config.PROMOTION_TYPE_OTHER)


def fct_active_promotions(daily: DataFrame, params: Params = DEFAULT) -> DataFrame:
    d = F.col("discount_pct")
    f = daily.where((d > 0) & (F.col("min_list_price") > 0) & (F.col("min_price") > 0))
    return f.select(
        "product_key", "product_id", "product_name", "brand_key", "brand", "store_key", "supermarket",
        "region_key", "region", "date_key", "scraped_date",
        F.col("min_price").alias("promotional_price"),
        F.col("min_list_price").alias("regular_price"),
        d.alias("discount_percentage"),
        "avg_price",
        (F.col("min_list_price") - F.col("min_price")).alias("absolute_discount"),
        round_half_up(d, 0).alias("discount_tier"),
        promotion_type(d).alias("promotion_type"),
        (d >= params.hot_deal_pct).alias("is_hot_deal"),
        "is_available",
    )


# ---------------------------------------------------------------- M-14
LEGITIMACY_ORDER = {"High Quality": 1, "Good Quality": 2, "Review Required": 3}


def fct_hot_deals_validated(promos: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Hot-deal quality scoring.

    Decisions: the effective threshold is ``min_hot_deal_pct`` AND ``is_hot_deal``
    (as executed: 30); persistence counts rows over the last 7 rows of the
    product x store history ordered by (date, region) — deterministic — and
    ``persistence_days`` counts distinct days in the 7-day range; every rank
    carries product/region tie-breaks.
    """
    d = F.col("discount_percentage")
    h = promos.where((d >= params.min_hot_deal_pct) & F.col("is_hot_deal")
                     & (F.col("regular_price") > F.col("promotional_price")))
    susp = d > params.suspicious_pct
    invalid = (F.col("promotional_price") <= 0) | (F.col("regular_price") <= 0)
    optimal = (d >= params.optimal_low_pct) & (d <= params.optimal_high_pct)
    known = F.col("brand").isNotNull() & (F.length("brand") > 2)
    h = h.select("*", susp.alias("is_suspicious_discount"), invalid.alias("has_invalid_price"),
                 optimal.alias("is_optimal_discount_range"), known.alias("has_known_brand"))
    b = lambda name, pts: F.when(F.col(name), pts).otherwise(0)
    nb = lambda name, pts: F.when(~F.col(name), pts).otherwise(0)
    score = (b("is_optimal_discount_range", 50) + nb("is_suspicious_discount", 30)
             + nb("has_invalid_price", 10) + b("has_known_brand", 10))
    legit = (F.when(F.col("is_suspicious_discount") | F.col("has_invalid_price"), "Suspicious")
              .when(F.col("is_optimal_discount_range") & F.col("has_known_brand"), "High Quality")
              .when(F.col("is_optimal_discount_range"), "Good Quality")
              .otherwise("Review Required"))
    h = h.withColumn("quality_score", score.cast("int")).withColumn("legitimacy_level", legit)

    # one window spec per distinct frame; history of one product in one store is
    # bounded by days x regions
    hist = Window.partitionBy("product_key", "store_key")
    rows7 = hist.orderBy("scraped_date", "region_key").rowsBetween(-(params.persistence_rows - 1), 0)
    days7 = hist.orderBy(F.unix_date("scraped_date")).rangeBetween(-(params.persistence_rows - 1), 0)
    h = (h.withColumn("deal_persistence_days", F.count(F.lit(1)).over(rows7))
          .withColumn("persistence_days", F.size(F.collect_set("scraped_date").over(days7)).cast("bigint")))
    h = h.withColumn("is_flash_deal", F.col("deal_persistence_days") == 1)

    day = ["store_key", "date_key"]  # a group grows with the catalogue: ranked across tasks
    tie = ["product_key", "region_key"]
    legit_rank = F.coalesce(F.try_element_at(
        F.create_map(*[x for k, v in LEGITIMACY_ORDER.items() for x in (F.lit(k), F.lit(v))]),
        F.col("legitimacy_level")), F.lit(4))
    h = ranks_within_groups(h, day, {
        "quality_rank": [(F.col("quality_score"), True), (d, True), *tie],
        "savings_rank": [(F.col("absolute_discount"), True), *tie],
        "overall_rank": [(legit_rank, False), (d, True), *tie]}, key=[*day, *tie])
    rec = (F.col("legitimacy_level").isin("High Quality", "Good Quality") & ~F.col("is_suspicious_discount")
           & ~F.col("is_flash_deal") & (F.col("quality_score") >= params.recommended_min_score))
    return h.select(
        "product_key", "product_id", "product_name", "brand_key", "brand", "store_key", "supermarket",
        "region_key", "region", "date_key", "scraped_date",
        "promotional_price", "regular_price", "discount_percentage", "absolute_discount",
        "quality_score", "legitimacy_level", "is_suspicious_discount", "has_invalid_price",
        "is_optimal_discount_range", "has_known_brand",
        "deal_persistence_days", "persistence_days", "is_flash_deal",
        F.col("quality_rank").cast("bigint").alias("quality_rank"),
        F.col("savings_rank").cast("bigint").alias("savings_rank"),
        F.col("overall_rank").cast("bigint").alias("overall_rank"),
        "is_available",
        rec.alias("is_recommended_deal"),
    )


# ---------------------------------------------------------------- M-15
def vw_suspicious_hot_deals(validated: DataFrame) -> DataFrame:
    """Suspicious deals with reasons, severity and review priority. A view has no order of
    its own; readers sort what they show."""
    d = F.col("discount_percentage")
    s, inv, fl, q = (F.col("is_suspicious_discount"), F.col("has_invalid_price"),
                     F.col("is_flash_deal"), F.col("quality_score"))
    v = validated.where((F.col("legitimacy_level") == "Suspicious") | s | inv | (fl & (d > 50)) | (q < 30))
    reasons = F.concat_ws(", ",
                          F.when(s, config.FLAG_EXTREME), F.when(inv, config.FLAG_INVALID),
                          F.when(fl, config.FLAG_FLASH), F.when(q < 50, config.FLAG_LOW_QUALITY))
    severity = (F.when(s, 5).otherwise(0) + F.when(inv, 4).otherwise(0)
                + F.when(fl & (d > 50), 3).otherwise(0) + F.when(q < 30, 2).otherwise(0))
    priority = (F.when(s & fl, "CRITICAL").when(s | inv, "HIGH").when(fl & (d > 50), "MEDIUM")
                 .otherwise("LOW"))
    out = v.select(
        "product_id", "product_name", "brand", "supermarket", "region", "scraped_date",
        "promotional_price", "regular_price", "discount_percentage", "absolute_discount",
        "quality_score", "legitimacy_level", "deal_persistence_days", "is_available",
        reasons.alias("suspicious_reasons"), severity.cast("int").alias("suspicion_severity"),
        priority.alias("review_priority"),
        "is_suspicious_discount", "has_invalid_price", "is_flash_deal",
    )
    return out


# ---------------------------------------------------------------- M-16
def fct_promotion_summary(promos: DataFrame, daily: DataFrame) -> DataFrame:
    """Promotion metrics per store x region x day.

    The input grain is product x store x region x day, so within a group each
    row is a distinct product: distinct product counts are plain counts (no
    Expand); only brands need a distinct aggregate.
    """
    keys = ["store_key", "supermarket", "region_key", "region", "date_key", "scraped_date"]
    d = F.col("discount_percentage")
    a = promos.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("products_on_promotion"),
        F.count_if(F.col("is_hot_deal")).alias("hot_deal_products"),
        F.count_distinct("brand_key").alias("brands_on_promotion"),
        money_avg(d).alias("avg_discount_pct"),
        F.min(d).alias("min_discount_pct"),
        F.max(d).alias("max_discount_pct"),
        snap(F.median(d)).alias("median_discount_pct"),
        money_sum("absolute_discount").alias("total_potential_savings"),
        money_avg("absolute_discount").alias("avg_absolute_discount"),
        money_avg("promotional_price").alias("avg_promotional_price"),
        money_avg("regular_price").alias("avg_regular_price"),
    )
    totals = daily.groupBy("store_key", "region_key", "date_key").agg(
        F.count(F.lit(1)).alias("total_products"))
    j = a.join(totals, ["store_key", "region_key", "date_key"], "left")
    return j.select(*keys, *[c for c in a.columns if c not in keys], "total_products",
                    pct("products_on_promotion", "total_products").alias("promotion_penetration_pct"))


# ---------------------------------------------------------------- M-17
def fct_daily_price_index(tru: DataFrame, exact_quantiles: bool = True) -> DataFrame:
    """Price distribution per store x region x day.

    ``exact_quantiles`` interpolates over counted distinct values (no value map in
    memory); False uses mergeable sketches for every quantile, the median included.
    """
    p = F.col("min_price")
    keys = ["supermarket", "region", "scraped_date"]
    probs = {"median_product_price": 0.5, "p25_product_price": 0.25, "p75_product_price": 0.75,
             "p90_product_price": 0.9, "p95_product_price": 0.95}
    t = tru.where(p.isNotNull())
    sketches = [] if exact_quantiles else [F.percentile_approx(p, x, 10000).alias(n) for n, x in probs.items()]
    a = t.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_products"),
        F.count_if(F.col("is_available")).alias("available_products"),
        F.count_if(~F.col("is_available")).alias("unavailable_products"),
        F.min(p).alias("min_product_price"),
        F.max(p).alias("max_product_price"),
        money_avg(p).alias("avg_product_price"),
        snap(F.stddev_samp(p)).alias("stddev_product_price"),
        F.sum("total_available_quantity").alias("total_inventory_units"),
        *sketches,
    )
    if exact_quantiles:
        q = group_quantiles(t, keys, "min_price", probs).select(
            *[F.col(k).alias(f"_{k}") for k in keys], *[snap(n).alias(n) for n in probs])
        a = a.join(q, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]).drop(*[f"_{k}" for k in keys])
    return a.withColumn("availability_rate_pct", pct("available_products", "total_products"))


# ---------------------------------------------------------------- M-18
def _comparison_measures(df: DataFrame) -> DataFrame:
    p, lo, hi = F.col("min_price"), F.col("lowest_price"), F.col("highest_price")
    return df.select(
        "*",
        (p - lo).alias("price_diff_vs_lowest"),
        pct(p - lo, lo).alias("price_premium_pct"),
        (hi - lo).alias("price_spread"),
        pct(hi - lo, lo).alias("price_spread_pct"),
        (F.col("price_rank") == 1).alias("is_cheapest"),
        (p == hi).alias("is_most_expensive"),
    )


def fct_price_comparison(tru: DataFrame) -> DataFrame:
    """Products sold by 2+ stores on a day: price position of each store x region row.

    A product-day group holds at most stores x regions rows (bounded by
    configuration), so one window pass — one shuffle — computes the group
    statistics, the store count filter and the rank.
    """
    t = tru.where(F.col("min_price").isNotNull()).select(
        "product_id", "product_name", "brand", "scraped_date", "supermarket", "region", "min_price",
        "avg_price", "is_available")
    g = Window.partitionBy("product_id", "scraped_date")
    p = F.col("min_price")
    t = t.select(
        "*",
        F.size(F.collect_set("supermarket").over(g)).alias("_stores"),
        F.min(p).over(g).alias("lowest_price"),
        F.max(p).over(g).alias("highest_price"),
        (F.sum(money_units(p)).over(g).cast("double") / F.count(p).over(g).cast("double") / 10000.0)
         .alias("market_avg_price"),
        F.row_number().over(g.orderBy(p, "supermarket", "region")).cast("bigint").alias("price_rank"),
    ).where(F.col("_stores") >= 2).drop("_stores")
    return _comparison_measures(t)


# ---------------------------------------------------------------- M-19
def normalized_name(c) -> F.Column:
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def fct_price_comparison_v2(daily: DataFrame) -> DataFrame:
    """Cross-store comparison by normalised product name and day.

    Name groups grow with the data (many products share a name), so group
    statistics come from a map-side-combined aggregate joined back (AQE splits a
    skewed join partition) and the rank from a range-partitioned ranking that
    spreads a hot group over many tasks — no window over a whole group.
    """
    t = daily.where(F.col("min_price").isNotNull()).select(
        "product_key", "product_id", "product_name", "brand_key", "brand", "date_key", "scraped_date",
        "store_key", "supermarket", "region_key", "region", "min_price", "avg_price", "is_available",
        normalized_name(F.col("product_name")).alias("product_name_normalized"))
    gk = ["product_name_normalized", "date_key"]
    stats = t.groupBy(*gk).agg(
        F.size(F.collect_set("store_key")).alias("_stores"),  # bounded by the number of stores
        F.min("min_price").alias("lowest_price"),
        F.max("min_price").alias("highest_price"),
        money_avg("min_price").alias("market_avg_price"),
    ).where(F.col("_stores") >= 2).drop("_stores")
    j = t.join(stats, gk, "inner")
    tie = ["store_key", "region_key", "product_key"]
    return _comparison_measures(ranks_within_groups(j, gk, {"price_rank": ["min_price", *tie]}, key=[*gk, *tie]))


# ---------------------------------------------------------------- M-20
def fct_product_availability(tru: DataFrame) -> DataFrame:
    q = F.col("total_available_quantity")
    status = (F.when(~F.col("is_available"), "out_of_stock").when(q == 0, "out_of_stock")
               .when(q <= 5, "low_stock").when(q <= 20, "medium_stock").otherwise("in_stock"))
    return tru.select(
        "product_id", "product_name", "brand", "supermarket", "region", "scraped_date", "is_available",
        "total_available_quantity", "sku_count", "min_price",
        status.alias("stock_status"),
        ((q > 0) & (q <= 5)).alias("is_low_inventory"),
    )
