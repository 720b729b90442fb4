"""Operational analytics over the scrape run / batch log (O-01 .. O-10, K-02, K-09)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import safe_div, snap
from ..operators.quantiles import group_quantiles

RUN_FIELDS = ["store", "region", "started_at", "finished_at", "status", "discovery_mode",
              "discovery_duration_seconds", "products_discovered", "products_scraped", "bytes_downloaded",
              "api_calls_count", "api_errors_count", "validation_errors_count", "duration_seconds",
              "error_message"]


def micros_avg(c) -> F.Column:
    """Average of microsecond-resolution seconds from an exact integer sum."""
    us = F.round(c * 1e6).cast("bigint")
    return F.sum(us).cast("double") / F.count(us).cast("double") / 1e6


def fold_runs(events: DataFrame) -> DataFrame:
    """O-10: run table from lifecycle events — per field, the latest non-NULL
    value wins (an omitted field never overwrites a known one). One
    map-side-combined aggregation per run."""
    ts = F.col("event_ts")
    aggs = [F.max_by(F.col(f), F.when(F.col(f).isNotNull(), ts)).alias(f) for f in RUN_FIELDS]
    return events.groupBy("run_id").agg(*aggs).withColumn(
        "output_path", F.concat(F.lit("bronze/supermarket="), F.col("store"), F.lit("/region="), F.col("region")))


def _since(as_of: dt.datetime, days: int):
    return F.col("started_at") > F.lit(as_of - dt.timedelta(days=days))


def o01_discovery_performance(runs: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    r = runs.where(_since(as_of, days) & F.col("discovery_duration_seconds").isNotNull())
    return r.groupBy("store", "discovery_mode").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.avg("discovery_duration_seconds").alias("avg_discovery_duration"),
        F.sum("products_discovered").alias("total_products_discovered"),
        F.avg("products_discovered").alias("avg_products_per_run"),
        snap(F.avg(safe_div("products_discovered", "discovery_duration_seconds"))).alias("avg_products_per_second"),
    )


def o02_discovery_trend(runs: DataFrame, as_of: dt.datetime, days: int = 30, store: str | None = None) -> DataFrame:
    r = runs.where(_since(as_of, days) & F.col("discovery_duration_seconds").isNotNull())
    if store:  # FLT-11: optional predicate
        r = r.where(F.col("store") == store)
    return r.groupBy(F.date_trunc("day", "started_at").alias("date"), "store").agg(
        F.avg("discovery_duration_seconds").alias("avg_discovery_duration"),
        F.avg("products_discovered").alias("avg_products_discovered"),
        F.count(F.lit(1)).alias("runs_count"),
    )


def _batches_in_window(batches: DataFrame, runs: DataFrame, as_of, days) -> DataFrame:
    # decision: the batch's own region (both tables carry one)
    recent = runs.where(_since(as_of, days)).select("run_id", F.col("store").alias("run_store"))
    return batches.join(recent, "run_id", "inner")


def o03_batch_performance(batches: DataFrame, runs: DataFrame, as_of, days: int = 7) -> DataFrame:
    b = _batches_in_window(batches, runs, as_of, days).where(F.col("region").isNotNull())
    rt = F.col("response_time_ms")
    q = group_quantiles(b, ["region"], "response_time_ms", {"p50_response_time_ms": 0.5, "p95_response_time_ms": 0.95})
    a = b.groupBy("region").agg(
        F.count(F.lit(1)).alias("total_batches"),
        F.avg(rt).alias("avg_response_time_ms"),
        F.avg("products_count").alias("avg_products_per_batch"),
        (F.count_if(~F.col("success")).cast("double") / F.count(F.lit(1))).alias("error_rate"),
    )
    return a.join(q, "region", "left").select(
        "region", "total_batches", "avg_response_time_ms", snap("p50_response_time_ms").alias("p50_response_time_ms"),
        snap("p95_response_time_ms").alias("p95_response_time_ms"), "avg_products_per_batch", "error_rate")


def o04_slowest_batches(batches: DataFrame, runs: DataFrame, as_of, days: int = 7, limit: int = 20) -> DataFrame:
    b = _batches_in_window(batches, runs, as_of, days).where(F.col("response_time_ms").isNotNull())
    return (b.select("run_id", F.col("run_store").alias("store"), "region", "batch_number", "response_time_ms",
                     "products_count", "api_status_code", "retry_count", "started_at")
             .orderBy(F.col("response_time_ms").desc(), "batch_number").limit(limit))


def o05_run_summary(runs: DataFrame, as_of, days: int = 7) -> DataFrame:
    r = runs.where(_since(as_of, days) & F.col("status").isin("success", "failed"))
    d = F.col("duration_seconds")
    return r.groupBy("store").agg(
        F.count(F.lit(1)).alias("total_runs"),
        (F.count_if(F.col("status") == "success").cast("double") / F.count(F.lit(1))).alias("success_rate"),
        micros_avg(d).alias("avg_total_duration"),
        F.avg("discovery_duration_seconds").alias("avg_discovery_duration"),
        micros_avg(d - F.coalesce("discovery_duration_seconds", F.lit(0.0))).alias("avg_scraping_duration"),
        F.avg("products_scraped").alias("avg_products_scraped"),
        snap(F.avg(safe_div("products_scraped", d))).alias("avg_products_per_second_overall"),
    )


def o06_breakdown(runs: DataFrame, batches: DataFrame, run_ids: DataFrame | None = None) -> DataFrame:
    """Per-run breakdown (run metadata + batch statistics) for the selected runs
    (all runs when none are given); an unknown run id yields no row."""
    r = runs if run_ids is None else runs.join(run_ids, "run_id", "left_semi")
    rt = F.col("response_time_ms")
    b = batches.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_batches"), F.avg(rt).alias("avg_response_time_ms"),
        F.min(rt).alias("min_response_time_ms"), F.max(rt).alias("max_response_time_ms"),
        F.sum("products_count").alias("total_products"),
        F.count_if(~F.col("success")).alias("failed_batches"))
    q = group_quantiles(batches, ["run_id"], "response_time_ms", {"p95_response_time_ms": 0.95})
    b = b.join(q.withColumn("p95_response_time_ms", snap("p95_response_time_ms")), "run_id", "left")
    return r.select("run_id", "store", "region", "started_at", "finished_at", "status", "discovery_mode",
                    "discovery_duration_seconds", "duration_seconds", "products_discovered",
                    "products_scraped").join(b, "run_id", "left")


def o07_recommendations(o1: DataFrame, o3: DataFrame, o5: DataFrame) -> DataFrame:
    """Three rule sets unioned: slow discovery (over O-01), slow regions (over O-03), low
    success (over O-05). The inputs are those results as stored, a few rows per store or region."""
    share = F.col("avg_discovery_duration") / (F.col("avg_discovery_duration") + 100) * 100
    disc = (o1.where(share > 30)
              .select(F.lit("discovery").alias("area"), F.col("store").alias("subject"),
                      share.alias("metric"),
                      F.lit("discovery takes over 30% of the run: cache the product list").alias("recommendation")))
    med = o3.agg(F.median("p95_response_time_ms").alias("_med"))  # one row
    slow = (o3.withColumn("_k", F.lit(1)).join(med.withColumn("_k", F.lit(1)), "_k")
              .where(F.col("p95_response_time_ms") > 2 * F.col("_med"))
              .select(F.lit("region").alias("area"), F.col("region").alias("subject"),
                      F.col("p95_response_time_ms").alias("metric"),
                      F.lit("p95 latency above twice the median region: lower concurrency").alias("recommendation")))
    low = (o5.where(F.col("success_rate") < 0.95)
             .select(F.lit("success").alias("area"), F.col("store").alias("subject"),
                     F.col("success_rate").alias("metric"),
                     F.lit("success rate below 95%: check errors and retries").alias("recommendation")))
    return disc.unionByName(slow).unionByName(low)


def o08_run_stats(runs: DataFrame) -> DataFrame:
    return runs.agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("status") == "success").alias("successful_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.sum("products_scraped").alias("total_products_scraped"),
        micros_avg(F.col("duration_seconds")).alias("avg_duration_seconds"),
        F.max("started_at").alias("last_run_at"),
    )


def o09_status_distribution(batches: DataFrame) -> DataFrame:
    return batches.groupBy("api_status_code").agg(F.count(F.lit(1)).alias("batches"),
                                                  F.sum("retry_count").alias("retries"))


def o09_discovery_modes(runs: DataFrame) -> DataFrame:
    return runs.groupBy("discovery_mode").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("discovery_mode") == "sitemap").alias("sitemap_runs"),
        F.count_if(F.col("discovery_mode") != "sitemap").alias("fallback_runs"))


def o09_latest_runs_like(runs: DataFrame, pattern: str, limit: int = 5) -> DataFrame:
    """FLT-08: the latest runs whose id matches a LIKE pattern."""
    return (runs.where(F.col("run_id").like(pattern))
                .select("run_id", "store", "discovery_mode", "discovery_duration_seconds", "products_discovered", "started_at")
                .orderBy(F.desc("started_at"), "run_id").limit(limit))


def k02_operational(runs: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Freshness (hours since the last run), success rate and products per day, per store."""
    per_store = runs.groupBy("store").agg(
        ((F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.max("finished_at"))).cast("double")
         / 1e6 / 3600).alias("freshness_hours"),
        (F.count_if(F.col("status") == "success").cast("double") / F.count(F.lit(1)) * 100).alias("success_rate_pct"),
        F.count_distinct(F.to_date("started_at")).alias("active_days"),
        F.sum("products_scraped").alias("products_scraped"),
    )
    return per_store.withColumn("products_per_day", F.col("products_scraped") / F.col("active_days"))


def k09_alerts(runs: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Rule-based market alerts per store: freshness > 24 h, success < 95 %,
    product count < 80 % of the average over stores."""
    k = k02_operational(runs, as_of)
    w = Window.partitionBy()  # over the per-store result: one row per store
    avg_products = F.avg("products_scraped").over(w)
    return k.select(
        "store", "freshness_hours", "success_rate_pct", "products_scraped",
        (F.col("freshness_hours") > 24).alias("stale_alert"),
        (F.col("success_rate_pct") < 95).alias("success_alert"),
        (F.col("products_scraped") < 0.8 * avg_products).alias("volume_alert"),
    )


def breakdown_for(runs: DataFrame, batches: DataFrame, run_id: str) -> DataFrame:
    """O-06 for one run; an unknown run id is an error, as in the reference."""
    ids = runs.sparkSession.createDataFrame([(run_id,)], "run_id string")
    out = o06_breakdown(runs, batches, ids)
    if out.isEmpty():
        raise ValueError(f"run {run_id} not found")
    return out
