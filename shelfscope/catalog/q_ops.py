"""Registered queries: operational run log (O-01 .. O-10, K-02, K-09)."""

from __future__ import annotations

import datetime as dt

from ..plans import observability as O
from ..plans.warehouse import warehouse
from ..sources import adapter
from .oracle import REGIONS, STORES, register as cte, with_ctes
from .registry import register

OPS_AS_OF = dt.datetime(2024, 1, 31)  # end of the event log's last day


def S(x):
    return f"CAST(CAST({x} AS DECIMAL(38,6)) AS DOUBLE)"


def MU(x):
    """Average of microsecond-resolution seconds from an exact integer sum (micros_avg)."""
    us = f"CAST(round(({x}) * 1e6) AS BIGINT)"
    return f"CAST(sum({us}) AS DOUBLE) / CAST(count({us}) AS DOUBLE) / 1e6"


def since(days):
    return f"started_at > TIMESTAMP '{(OPS_AS_OF - dt.timedelta(days=days)).isoformat(sep=' ')}'"


cte("batches", f"""
batches AS (
  SELECT 'b' || CAST(event_id AS VARCHAR) AS batch_id,
         'run_' || CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS run_id,
         event_id AS batch_number,
         ({STORES})[user_id % 5 + 1] AS store, ({REGIONS})[user_id % 8 + 1] AS region,
         (['sitemap', 'category', 'fallback'])[user_id % 3 + 1] AS discovery_mode,
         ts AS started_at,
         make_timestamp(epoch_us(ts) + CAST(round(value * 100, 0) * 1000 AS BIGINT)) AS finished_at,
         CAST(event_id % 50 + 1 AS INTEGER) AS products_count,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS api_status_code,
         round(value * 100, 0) AS response_time_ms,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS retry_count,
         event_type <> 'error' AS success,
         event_type = 'view' AS _view, event_type = 'signup' AS _signup
  FROM events
)""", [])

cte("runs", """
runs AS (
  SELECT run_id, any_value(store) AS store, any_value(region) AS region,
         min(started_at) AS started_at, max(finished_at) AS finished_at,
         CASE WHEN count(*) FILTER (WHERE NOT success) * 2 > count(*) THEN 'failed' ELSE 'success' END AS status,
         any_value(discovery_mode) AS discovery_mode,
         CAST(count(*) AS DOUBLE) * 1.5 AS discovery_duration_seconds,
         CAST(sum(products_count) + count(*) FILTER (WHERE _view) AS BIGINT) AS products_discovered,
         CAST(sum(CASE WHEN success THEN products_count ELSE 0 END) AS BIGINT) AS products_scraped,
         CAST(sum(products_count) * 2048 AS BIGINT) AS bytes_downloaded,
         count(*) AS api_calls_count, count(*) FILTER (WHERE NOT success) AS api_errors_count,
         count(*) FILTER (WHERE _signup) AS validation_errors_count,
         CAST(epoch_us(max(finished_at)) - epoch_us(min(started_at)) AS DOUBLE) / 1e6 AS duration_seconds,
         CASE WHEN count(*) FILTER (WHERE NOT success) * 2 > count(*) THEN 'api errors' END AS error_message,
         'bronze/supermarket=' || any_value(store) || '/region=' || any_value(region) AS output_path
  FROM batches GROUP BY run_id
)""", ["batches"])


def _b(spark, sf):
    return adapter.scraper_batches(spark, sf)


def _runs(spark, sf):
    return O.fold_runs(adapter.run_events(_b(spark, sf)))


def _stored(spark, sf, name):
    """A result other results build on, written once per build."""
    build = {"O-01": lambda: O.o01_discovery_performance(_runs(spark, sf), OPS_AS_OF),
             "O-03": lambda: O.o03_batch_performance(_b(spark, sf), _runs(spark, sf), OPS_AS_OF),
             "O-05": lambda: O.o05_run_summary(_runs(spark, sf), OPS_AS_OF)}[name]
    return warehouse(spark, sf).table(name, build)


@register("O-10", with_ctes(["runs"], "SELECT * FROM runs"))
def o10(spark, sf):
    return _runs(spark, sf)


_O1 = f"""SELECT store, discovery_mode, count(*) AS total_runs,
       avg(discovery_duration_seconds) AS avg_discovery_duration,
       CAST(sum(products_discovered) AS BIGINT) AS total_products_discovered,
       avg(products_discovered) AS avg_products_per_run,
       {S("avg(products_discovered / nullif(discovery_duration_seconds, 0))")} AS avg_products_per_second
FROM runs WHERE {since(7)} AND discovery_duration_seconds IS NOT NULL GROUP BY store, discovery_mode"""


@register("O-01", with_ctes(["runs"], _O1))
def o01(spark, sf):
    return _stored(spark, sf, "O-01")


@register("O-02", with_ctes(["runs"], f"""
SELECT date_trunc('day', started_at) AS date, store, avg(discovery_duration_seconds) AS avg_discovery_duration,
       avg(products_discovered) AS avg_products_discovered, count(*) AS runs_count
FROM runs WHERE {since(30)} AND discovery_duration_seconds IS NOT NULL
GROUP BY date_trunc('day', started_at), store"""))
def o02(spark, sf):
    return O.o02_discovery_trend(_runs(spark, sf), OPS_AS_OF)


_O3 = f"""SELECT b.region, count(*) AS total_batches, avg(response_time_ms) AS avg_response_time_ms,
       {S("quantile_cont(response_time_ms, 0.5)")} AS p50_response_time_ms,
       {S("quantile_cont(response_time_ms, 0.95)")} AS p95_response_time_ms,
       avg(products_count) AS avg_products_per_batch,
       CAST(count(*) FILTER (WHERE NOT success) AS DOUBLE) / count(*) AS error_rate
FROM batches b JOIN runs r ON b.run_id = r.run_id
WHERE r.{since(7)} AND b.region IS NOT NULL GROUP BY b.region"""


@register("O-03", with_ctes(["runs"], _O3))
def o03(spark, sf):
    return _stored(spark, sf, "O-03")


@register("O-04", with_ctes(["runs"], f"""
SELECT b.run_id, r.store, b.region, b.batch_number, b.response_time_ms, b.products_count, b.api_status_code,
       b.retry_count, b.started_at
FROM batches b JOIN runs r ON b.run_id = r.run_id
WHERE r.{since(7)} AND b.response_time_ms IS NOT NULL
ORDER BY b.response_time_ms DESC, b.batch_number LIMIT 20"""))
def o04(spark, sf):
    return O.o04_slowest_batches(_b(spark, sf), _runs(spark, sf), OPS_AS_OF)


_O5 = f"""SELECT store, count(*) AS total_runs,
       CAST(count(*) FILTER (WHERE status = 'success') AS DOUBLE) / count(*) AS success_rate,
       {MU("duration_seconds")} AS avg_total_duration,
       avg(discovery_duration_seconds) AS avg_discovery_duration,
       {MU("duration_seconds - coalesce(discovery_duration_seconds, 0)")} AS avg_scraping_duration,
       avg(products_scraped) AS avg_products_scraped,
       {S("avg(products_scraped / nullif(duration_seconds, 0))")} AS avg_products_per_second_overall
FROM runs WHERE {since(7)} AND status IN ('success', 'failed') GROUP BY store"""


@register("O-05", with_ctes(["runs"], _O5))
def o05(spark, sf):
    return _stored(spark, sf, "O-05")


@register("O-06", with_ctes(["runs"], f"""
, bs AS (SELECT run_id, count(*) AS total_batches, avg(response_time_ms) AS avg_response_time_ms,
               min(response_time_ms) AS min_response_time_ms, max(response_time_ms) AS max_response_time_ms,
               {S("quantile_cont(response_time_ms, 0.95)")} AS p95_response_time_ms,
               CAST(sum(products_count) AS BIGINT) AS total_products,
               count(*) FILTER (WHERE NOT success) AS failed_batches
        FROM batches GROUP BY run_id)
SELECT r.run_id, store, region, started_at, finished_at, status, discovery_mode, discovery_duration_seconds,
       duration_seconds, products_discovered, products_scraped, total_batches, avg_response_time_ms,
       min_response_time_ms, max_response_time_ms, p95_response_time_ms, total_products, failed_batches
FROM runs r LEFT JOIN bs ON r.run_id = bs.run_id"""))
def o06(spark, sf):
    return O.o06_breakdown(_runs(spark, sf), _b(spark, sf))


@register("O-07", with_ctes(["runs"], f"""
, o1 AS ({_O1}), o3 AS ({_O3}), o5 AS ({_O5})
SELECT 'discovery' AS area, store AS subject, avg_discovery_duration / (avg_discovery_duration + 100) * 100 AS metric,
       'discovery takes over 30% of the run: cache the product list' AS recommendation
FROM o1 WHERE avg_discovery_duration / (avg_discovery_duration + 100) * 100 > 30
UNION ALL
SELECT 'region', region, p95_response_time_ms, 'p95 latency above twice the median region: lower concurrency'
FROM o3 WHERE p95_response_time_ms > 2 * (SELECT median(p95_response_time_ms) FROM o3)
UNION ALL
SELECT 'success', store, success_rate, 'success rate below 95%: check errors and retries'
FROM o5 WHERE success_rate < 0.95"""))
def o07(spark, sf):
    return O.o07_recommendations(*[_stored(spark, sf, k) for k in ("O-01", "O-03", "O-05")])


@register("O-08", with_ctes(["runs"], f"""
SELECT count(*) AS total_runs, count(*) FILTER (WHERE status = 'success') AS successful_runs,
       count(*) FILTER (WHERE status = 'failed') AS failed_runs,
       CAST(sum(products_scraped) AS BIGINT) AS total_products_scraped,
       {MU("duration_seconds")} AS avg_duration_seconds, max(started_at) AS last_run_at
FROM runs"""))
def o08(spark, sf):
    return O.o08_run_stats(_runs(spark, sf))


@register("O-09", with_ctes(["batches"], """
SELECT api_status_code, count(*) AS batches, CAST(sum(retry_count) AS BIGINT) AS retries
FROM batches GROUP BY api_status_code"""))
def o09(spark, sf):
    return O.o09_status_distribution(_b(spark, sf))


@register("FLT-08", with_ctes(["runs"], """
SELECT run_id, store, discovery_mode, discovery_duration_seconds, products_discovered, started_at
FROM runs WHERE run_id LIKE 'run_1%' ORDER BY started_at DESC, run_id LIMIT 5"""))
def flt08(spark, sf):
    """The latest runs whose id starts with a prefix (a LIKE pattern), as the report on discovery shows them."""
    return O.o09_latest_runs_like(_runs(spark, sf), "run_1%")


@register("O-09b", with_ctes(["runs"], """
SELECT discovery_mode, count(*) AS runs, count(*) FILTER (WHERE discovery_mode = 'sitemap') AS sitemap_runs,
       count(*) FILTER (WHERE discovery_mode <> 'sitemap') AS fallback_runs
FROM runs GROUP BY discovery_mode"""))
def o09b(spark, sf):
    return O.o09_discovery_modes(_runs(spark, sf))


_K2 = f"""SELECT store,
       CAST(epoch_us(TIMESTAMP '{OPS_AS_OF.isoformat(sep=' ')}') - epoch_us(max(finished_at)) AS DOUBLE) / 1e6 / 3600 AS freshness_hours,
       CAST(count(*) FILTER (WHERE status = 'success') AS DOUBLE) / count(*) * 100 AS success_rate_pct,
       count(DISTINCT CAST(started_at AS DATE)) AS active_days,
       CAST(sum(products_scraped) AS BIGINT) AS products_scraped,
       CAST(sum(products_scraped) AS BIGINT) / count(DISTINCT CAST(started_at AS DATE)) AS products_per_day
FROM runs GROUP BY store"""


@register("K-02", with_ctes(["runs"], _K2))
def k02(spark, sf):
    return O.k02_operational(_runs(spark, sf), OPS_AS_OF)


@register("K-09", with_ctes(["runs"], f"""
, k AS ({_K2})
SELECT store, freshness_hours, success_rate_pct, products_scraped, freshness_hours > 24 AS stale_alert,
       success_rate_pct < 95 AS success_alert, products_scraped < 0.8 * avg(products_scraped) OVER () AS volume_alert
FROM k"""))
def k09(spark, sf):
    return O.k09_alerts(_runs(spark, sf), OPS_AS_OF)
