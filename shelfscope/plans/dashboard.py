"""Dashboard queries (D-01 .. D-08) over the built tables.

The UI period is a parameter (inclusive both ends, FLT-06); the reference's
page-size LIMITs without ORDER BY are dropped (they return arbitrary rows) and
the full, ordered result is returned instead. One-row KPI aggregates from
different tables are combined by an equi-join on a constant key (1 x 1 rows).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import money_units, money_avg, money_sum, pct, round_half_up


def period(as_of: dt.date, days: int = 30) -> tuple[dt.date, dt.date]:
    return as_of - dt.timedelta(days=days - 1), as_of


def in_period(col: str, start: dt.date, end: dt.date):
    return F.col(col).between(F.lit(start), F.lit(end))


def _one_row(*frames: DataFrame) -> DataFrame:
    out = frames[0].withColumn("_k", F.lit(1))
    for f in frames[1:]:
        out = out.join(f.withColumn("_k", F.lit(1)), "_k")
    return out.drop("_k")


def d01_kpis(tru: DataFrame, dim_store: DataFrame, dim_region: DataFrame, start, end) -> DataFrame:
    t = tru.where(in_period("scraped_date", start, end))
    a = t.agg(F.count_distinct("product_id").alias("total_products"))
    p = t.where(F.col("min_price") > 0).agg(round_half_up(money_avg("min_price"), 2).alias("avg_price"))
    s = dim_store.where("is_active").agg(F.count_distinct("store_name").alias("total_stores"))
    r = dim_region.agg(F.count_distinct("region_code").alias("total_regions"))
    return _one_row(a, s, r, p)


def d02_promo_kpis(promos: DataFrame) -> DataFrame:
    d = F.col("discount_percentage")
    return promos.agg(
        F.count_distinct("product_id").alias("products_on_promo"),
        round_half_up(money_avg(d), 1).alias("avg_discount"),
        F.count_if(d >= 30).alias("hot_deals"),
        round_half_up(money_sum(F.col("regular_price") - F.col("promotional_price")), 2).alias("total_savings"),
    )


def _store_prices(tru: DataFrame, dim_store: DataFrame, start, end) -> DataFrame:
    s = F.broadcast(dim_store.where("is_active").select(F.col("store_id").alias("supermarket"), "store_name"))
    return tru.where((F.col("min_price") > 0) & in_period("scraped_date", start, end)).join(s, "supermarket")


def d03_leaders(tru: DataFrame, promos: DataFrame, dim_store: DataFrame, start, end) -> DataFrame:
    price = (_store_prices(tru, dim_store, start, end).groupBy("store_name")
             .agg(round_half_up(money_avg("min_price"), 2).alias("value"))
             .orderBy("value", "store_name").limit(1)
             .select(F.lit("price_leader").alias("leader"), "store_name", "value"))
    s = F.broadcast(dim_store.where("is_active").select("store_key", "store_name"))
    promo = (promos.join(s, "store_key").groupBy("store_name")
             .agg(F.count_distinct("product_id").cast("double").alias("value"))
             .orderBy(F.col("value").desc(), "store_name").limit(1)
             .select(F.lit("promo_leader").alias("leader"), "store_name", "value"))
    return price.unionByName(promo)


def d04_period_change(tru: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Average price of the period vs the previous period of equal length, one pass."""
    n = (end - start).days + 1
    pstart, pend = start - dt.timedelta(days=n), start - dt.timedelta(days=1)
    t = tru.where((F.col("min_price") > 0) & F.col("scraped_date").between(F.lit(pstart), F.lit(end)))
    cur = in_period("scraped_date", start, end)
    prev = in_period("scraped_date", pstart, pend)
    c = F.col("min_price")
    agg = t.agg(
        (F.sum(F.when(cur, money_units(c))).cast("double") / F.count(F.when(cur, c)).cast("double") / 10000.0).alias("cur"),
        (F.sum(F.when(prev, money_units(c))).cast("double") / F.count(F.when(prev, c)).cast("double") / 10000.0).alias("prev"),
    )
    return agg.select(round_half_up("cur", 2).alias("current_avg_price"),
                      round_half_up("prev", 2).alias("previous_avg_price"),
                      pct(F.col("cur") - F.col("prev"), "prev").alias("change_pct"))


def d05_store_comparison(tru: DataFrame, dim_store: DataFrame, start, end) -> DataFrame:
    return (_store_prices(tru, dim_store, start, end).groupBy("store_name")
            .agg(round_half_up(money_avg("min_price"), 2).alias("avg_price"),
                 F.count_distinct("product_id").alias("product_count"))
            .orderBy("avg_price", "store_name"))


def d05_price_evolution(tru: DataFrame, start, end) -> DataFrame:
    return (tru.where((F.col("min_price") > 0) & in_period("scraped_date", start, end))
               .groupBy("scraped_date").agg(round_half_up(money_avg("min_price"), 2).alias("avg_price"))
               .orderBy("scraped_date"))


def d05_promo_by_store(promos: DataFrame, dim_store: DataFrame) -> DataFrame:
    s = F.broadcast(dim_store.where("is_active").select("store_key", "store_name"))
    return (promos.join(s, "store_key").groupBy("store_name")
                  .agg(F.count_distinct("product_id").alias("products_on_promo"),
                       round_half_up(money_avg("discount_percentage"), 1).alias("avg_discount"))
                  .orderBy(F.col("products_on_promo").desc(), "store_name"))


def d06_direction(tru: DataFrame, start, end) -> DataFrame:
    """Day-over-day change of the daily average (lag over the day series: one row per day)."""
    daily = (tru.where((F.col("min_price") > 0) & in_period("scraped_date", start, end))
                .groupBy("scraped_date").agg(money_avg("min_price").alias("avg_price")))
    w = Window.orderBy("scraped_date")  # one row per day: bounded by the period length
    prev = F.lag("avg_price").over(w)
    chg = F.col("avg_price") - prev
    return daily.select(
        "scraped_date", round_half_up("avg_price", 2).alias("avg_price"),
        round_half_up(prev, 2).alias("prev_avg_price"),
        round_half_up(chg, 2).alias("change"),
        F.when(prev.isNull(), None).when(chg > 0, "up").when(chg < 0, "down").otherwise("flat").alias("direction"))


def d06_penetration(tru: DataFrame, promos: DataFrame, start, end) -> DataFrame:
    t = tru.where(in_period("scraped_date", start, end)).agg(F.count_distinct("product_id").alias("total_products"))
    p = promos.agg(F.count_distinct("product_id").alias("products_on_promo"))
    j = _one_row(t, p)
    return j.select("total_products", "products_on_promo",
                    round_half_up(F.col("products_on_promo") / F.greatest(F.col("total_products"), F.lit(1)) * 100, 1)
                    .alias("promo_penetration_pct"))


def d07_coverage(tru: DataFrame, start, end) -> DataFrame:
    return tru.agg(
        F.count_if(in_period("scraped_date", start, end)).alias("rows_in_period"),
        F.size(F.collect_set(F.when(in_period("scraped_date", start, end), F.col("scraped_date"))))
         .cast("bigint").alias("days_with_data"),
        F.lit((end - start).days + 1).cast("bigint").alias("days_in_period"),
        F.max("scraped_date").alias("latest_scrape"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("product_id").alias("total_products"),
    )


def d08_price_rows(daily: DataFrame, dim_store: DataFrame, stores=("bistek", "fort", "giassi")) -> DataFrame:
    s = F.broadcast(dim_store.select("store_key", "store_id", F.col("store_name").alias("supermarket")))
    return (daily.select("store_key", "product_id", "region", "scraped_date", "min_price").join(s, "store_key")
                 .where(F.col("store_id").isin(*stores) & F.col("min_price").between(1, 500))
                 .select("supermarket", "product_id", "region", "scraped_date", "min_price"))


def d08_promotions(promos: DataFrame, dim_store: DataFrame, min_pct: float = 30) -> DataFrame:
    s = F.broadcast(dim_store.select("store_key", F.col("store_name").alias("supermarket")))
    p = promos.select("store_key", "product_id", "product_name", "region", "scraped_date",
                      "promotional_price", "discount_percentage")
    return (p.join(s, "store_key").where(F.col("discount_percentage") >= min_pct)
                  .select("product_id", "product_name", "supermarket", "region", "scraped_date",
                          round_half_up("promotional_price", 2).alias("promo_price"),
                          round_half_up("discount_percentage", 1).alias("discount_pct")))


def d08_competitiveness(cmp_v2: DataFrame) -> DataFrame:
    return (cmp_v2.groupBy("product_id", "product_name")
                  .agg(F.size(F.collect_set("store_key")).cast("bigint").alias("store_count"),
                       F.min("min_price").alias("lowest_price"), F.max("min_price").alias("highest_price"))
                  .where(F.col("store_count") >= 2))
