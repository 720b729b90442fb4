"""Registered queries: staging, trusted, dimensions, facts (M-01 .. M-21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.warehouse import warehouse
from .oracle import with_ctes
from .registry import register


def _wh(spark, sf):
    return warehouse(spark, sf)


@register("M-01", with_ctes(["obs"], """
SELECT product_id, product_name, brand, product_url, supermarket, region, postal_code, hub_id,
       run_id, scraped_at, CASE WHEN line_number % 2 = 0 THEN 2 ELSE 1 END AS item_count
FROM obs"""))
def m01(spark, sf):
    s = _wh(spark, sf).stg()
    return s.select("product_id", "product_name", "brand", "product_url", "supermarket", "region",
                    "postal_code", "hub_id", "run_id", "scraped_at", F.size("items").alias("item_count"))


TRU_COLS = ["product_id", "product_name", "brand", "product_url", "supermarket", "region", "postal_code",
            "hub_id", "min_price", "max_price", "avg_price", "min_list_price", "sku_count", "is_available",
            "total_available_quantity", "run_id", "scraped_date", "scraped_at"]


@register("M-03", with_ctes(["tru"], f"""
SELECT {", ".join(TRU_COLS)}, array_to_string(eans, '|') AS eans FROM tru"""))
def m03(spark, sf):
    t = _wh(spark, sf).tru()
    return t.select(*TRU_COLS, F.array_join("eans", "|").alias("eans"))


def _dim(name, arrays=()):
    def run(spark, sf):
        d = _wh(spark, sf).dim(name)
        return d.select(*[F.array_join(c, "|").alias(c) if c in arrays else F.col(c) for c in d.columns])
    return run


for _id, _name, _arrays in [
    ("M-04", "dim_date", ()),
    ("M-06", "dim_product", ("stores_carrying",)),
    ("M-07", "dim_brand", ()),
    ("M-08", "dim_region", ("postal_codes", "stores_in_region")),
    ("M-09", "dim_location", ()),
    ("M-10", "dim_store_location", ()),
    ("M-11", "dim_ean", ()),
]:
    _sel = "SELECT * " if not _arrays else "SELECT * EXCLUDE (" + ", ".join(_arrays) + "), " + ", ".join(
        f"array_to_string({a}, '|') AS {a}" for a in _arrays) + " "
    register(_id, with_ctes([_name], _sel + f"FROM {_name}"))(_dim(_name, _arrays))


@register("M-02", with_ctes(["stg_ref"], """
SELECT ean_code, product_name, brands, categories, quantity, countries, nutriscore_grade, run_id, scraped_at
FROM stg_ref"""))
def m02(spark, sf):
    return _wh(spark, sf).reference().select(
        "ean_code", "product_name", "brands", "categories", "quantity", "countries", "nutriscore_grade",
        "run_id", "scraped_at")


def _fact(name):
    def run(spark, sf):
        return _wh(spark, sf).fact(name)
    return run


for _id, _name in [
    ("M-12", "fct_daily_prices"),
    ("M-13", "fct_active_promotions"),
    ("M-14", "fct_hot_deals_validated"),
    ("M-15", "vw_suspicious_hot_deals"),
    ("M-16", "fct_promotion_summary"),
    ("M-17", "fct_daily_price_index"),
    ("M-18", "fct_price_comparison"),
    ("M-19", "fct_price_comparison_v2"),
    ("M-20", "fct_product_availability"),
]:
    register(_id, with_ctes([_name], f"SELECT * FROM {_name}"))(_fact(_name))


@register("M-05", with_ctes(["dim_store", "tru"], """
SELECT s.*, o.observed_products, o.observed_regions, o.first_seen_date, o.last_seen_date
FROM dim_store s LEFT JOIN (
  SELECT supermarket, count(DISTINCT product_id) AS observed_products, count(DISTINCT region) AS observed_regions,
         min(scraped_date) AS first_seen_date, max(scraped_date) AS last_seen_date
  FROM tru GROUP BY supermarket) o ON s.store_id = o.supermarket"""))
def m05(spark, sf):
    """dim_store (the store seed with keys and classifications) with the coverage
    observed in the trusted table."""
    w = _wh(spark, sf)
    obs = w.tru().groupBy(F.col("supermarket").alias("store_id")).agg(
        F.count_distinct("product_id").alias("observed_products"),
        F.size(F.collect_set("region")).cast("bigint").alias("observed_regions"),
        F.min("scraped_date").alias("first_seen_date"), F.max("scraped_date").alias("last_seen_date"))
    return w.dim("dim_store").join(F.broadcast(obs), "store_id", "left")  # one row per store
