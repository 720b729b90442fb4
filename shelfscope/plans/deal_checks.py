"""Deal re-validation (V-01 .. V-03) and URL discovery jobs (DSC-01 .. DSC-05)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.columns import round_half_up
from ..sources.tables import read_table


def select_deals(hot: DataFrame, tru: DataFrame, day: dt.date, min_discount: float = 30,
                 store: str | None = None) -> DataFrame:
    """V-02: deals of a day above a discount, with their product URL.

    The reference's correlated ``(SELECT url ... LIMIT 1)`` becomes a join to one
    URL per product x store (the smallest: deterministic). URLs grow with the products, and the size of
    packed files tells little of their own, so they are merged and never broadcast.
    """
    h = hot.where((F.col("scraped_date") == F.lit(day)) & (F.col("discount_percentage") >= min_discount))
    if store:  # FLT-11: optional predicate
        h = h.where(F.col("supermarket") == store)
    urls = tru.groupBy("product_id", "supermarket").agg(F.min("product_url").alias("product_url"))
    return h.join(urls.hint("merge"), ["product_id", "supermarket"], "left").select(
        "product_id", "supermarket", "region", "scraped_date",
        F.col("promotional_price").alias("expected_price"),
        F.col("discount_percentage").alias("expected_discount"), "product_url")


def recheck(deals: DataFrame, live: DataFrame) -> DataFrame:
    """V-01: active when the live price is within 5 % above the expected price and
    the live discount keeps 90 % of the expected one; expired otherwise; error when
    nothing was extracted or the fetch failed; no_url without a URL."""
    one = live.withColumn("_rn", F.row_number().over(Window.partitionBy("url").orderBy("page_id"))) \
              .where("_rn = 1").drop("_rn")  # pages per URL: bounded
    one = one.select(F.col("url").alias("product_url"), F.col("url").alias("_url"), F.col("status").alias("_st"),
                     "live_price", "live_discount_pct")
    j = deals.join(one.hint("merge"), "product_url", "left")  # one row a page: as select_deals
    ok = ((F.col("live_price") <= F.col("expected_price") * 1.05)
          & (F.col("live_discount_pct") >= F.col("expected_discount") * 0.90))
    status = (F.when(F.col("product_url").isNull(), "no_url")
               .when(F.col("_url").isNull() | (F.col("_st") != 200) | F.col("live_price").isNull(), "error")
               .when(ok, "active").otherwise("expired"))
    return j.select(*deals.columns, "live_price", "live_discount_pct", status.alias("status"))


def outcome_stats(checked: DataFrame) -> DataFrame:
    """V-03: deals per outcome with their share (window over the per-status result)."""
    g = checked.groupBy("status").agg(F.count(F.lit(1)).alias("deals"))
    return g.withColumn("pct", round_half_up(F.col("deals") * 100.0 / F.sum("deals").over(Window.partitionBy()), 1))


def incremental_by_lastmod(urls: DataFrame, since: dt.date) -> DataFrame:
    """DSC-02: lastmod on or after ``since``; missing or unparsable dates are kept."""
    return urls.where(F.col("lastmod").isNull() | (F.col("lastmod") >= F.lit(since)))


def new_only(urls: DataFrame, stg: DataFrame) -> DataFrame:
    """DSC-01: URLs not collected on the latest collection day (anti join)."""
    s = stg.select("product_url", F.to_date("scraped_at").alias("d"))
    last = s.agg(F.max("d").alias("d"))
    seen = s.join(last, "d", "left_semi").select(F.col("product_url").alias("url"))
    return urls.join(seen, "url", "left_anti")


def sample_bound(rate: float) -> str:
    """The least 8-digit hexadecimal number beyond share ``rate`` of all."""
    return f"{min(int(rate * 2**32), 2**32 - 1):08x}"


def sample_urls(urls: DataFrame, priority: list[str], rate: float, seed: int = 42) -> DataFrame:
    """DSC-03 / SRT-05: every URL matching a priority pattern plus a deterministic
    hash sample of the rest (same URL -> same decision on every run, in any engine that
    has md5)."""
    prio = F.lit(False)
    for p in priority:
        prio = prio | F.col("url").rlike(p)
    sampled = F.substring(F.md5(F.concat(F.col("url"), F.lit(f"|{seed}"))), 1, 8) < sample_bound(rate)
    return urls.where(prio | sampled).withColumn("priority", prio)


def failed_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed-fetch cache derived from the driver's pages and from the product pages of every
    ninth part: one failure per page, spread over the last 20 days."""
    pages = read_table(spark, sf_dir, "pages", "page_id", "url")
    parts = read_table(spark, sf_dir, "part", "p_partkey", "p_name").where(F.pmod("p_partkey", F.lit(9)) == 0)
    k = F.col("p_partkey")
    store = F.get(F.array(*[F.lit(x) for x in config.ADAPTER_STORES]), F.pmod(k, F.lit(5)).cast("int"))
    products = parts.select(k.alias("page_id"), F.concat(
        F.lit("https://www."), store, F.lit(".com.br/"), F.replace(F.lower("p_name"), F.lit(" "), F.lit("-")), F.lit("-"),
        k.cast("string"), F.lit("/p")).alias("url"))
    return pages.unionByName(products).select(
        "url", (F.lit("2026-03-01 00:00:00").cast("timestamp")
                - F.make_dt_interval(F.pmod("page_id", F.lit(20)).cast("int"))).alias("failed_at"),
        F.when(F.pmod("page_id", F.lit(2)) == 0, 404).otherwise(500).alias("status"))


def exclude_cached_failures(urls: DataFrame, failed: DataFrame, now: dt.datetime, ttl_days: int = 7) -> DataFrame:
    """DSC-04: drop URLs whose failure is younger than the TTL."""
    fresh = failed.where(F.col("failed_at") >= F.lit(now - dt.timedelta(days=ttl_days))).select("url")
    return urls.join(fresh, "url", "left_anti")


def failed_url_stats(failed: DataFrame, today: dt.date, ttl_days: int = 7) -> DataFrame:
    """DSC-05: valid / expired entries and age bands 0-1, 2-3, 4-7, >7 days."""
    age = F.datediff(F.lit(today), F.to_date("failed_at"))
    band = F.when(age <= 1, "0-1").when(age <= 3, "2-3").when(age <= 7, "4-7").otherwise(">7")
    return failed.withColumn("_age", age).groupBy(band.alias("age_band")).agg(
        F.count(F.lit(1)).alias("urls"), F.count_if(F.col("_age") <= ttl_days).alias("valid"),
        F.count_if(F.col("_age") > ttl_days).alias("expired"),
        F.min("failed_at").alias("oldest"), F.max("failed_at").alias("newest"))
