"""Registered queries: reports (R-*) and dashboard (D-*)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import config
from ..plans import dashboard as D
from ..plans import reports as R
from ..plans.warehouse import warehouse
from .oracle import MAVG, MSUM, PCT, R as RND, register as cte, with_ctes
from .registry import register

AS_OF = config.DEFAULT_AS_OF
SINCE7 = (AS_OF - dt.timedelta(days=7)).isoformat()
H_LO = (AS_OF - dt.timedelta(days=7)).isoformat()
H_HI = (AS_OF - dt.timedelta(days=3)).isoformat()
START, END = D.period(AS_OF)
PSTART, PEND = START - dt.timedelta(days=30), START - dt.timedelta(days=1)


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


cte("silver_products", """
silver_products AS (
  SELECT scraped_at AS collected_at, region, supermarket, product_id AS sku, product_name AS name, brand,
         regexp_replace(trim(coalesce(ean, '')), '^0+', '') AS ean, price, list_price,
         available_quantity AS stock
  FROM obs WHERE price > 0
)""", ["obs"])

cte("snapshot", f"""
snapshot AS (
  WITH recent AS (SELECT *, CAST(collected_at AS DATE) AS d FROM silver_products
                  WHERE collected_at >= TIMESTAMP '{SINCE7}'),
  latest AS (SELECT supermarket, region, max(d) AS d FROM recent GROUP BY supermarket, region)
  SELECT r.supermarket, r.region, sku, name, brand, price, list_price, stock, collected_at, ean
  FROM recent r JOIN latest l ON r.supermarket = l.supermarket AND r.region = l.region AND r.d = l.d
  WHERE price > 0 AND ean IS NOT NULL AND ean <> ''
)""", ["silver_products"])


def _wh(spark, sf):
    return warehouse(spark, sf)


def _silver(spark, sf):
    return _wh(spark, sf).silver()


def _snap(spark, sf):
    return _wh(spark, sf).snapshot()


@register("SRC-05", with_ctes(["silver_products"], "SELECT * FROM silver_products"))
def src05(spark, sf):
    return R.silver_products(_wh(spark, sf).bronze())


@register("R-00", with_ctes(["snapshot"], "SELECT * FROM snapshot"))
def r00(spark, sf):
    return R.build_snapshot(_silver(spark, sf), AS_OF)


@register("R-01", with_ctes(["snapshot"], f"""
SELECT supermarket, count(DISTINCT ean) AS product_mix, {RND(MAVG("price"), 2)} AS avg_ticket,
       count(DISTINCT region) AS regions_monitored, max(collected_at) AS last_update
FROM snapshot GROUP BY supermarket"""))
def r01(spark, sf):
    return R.r01_scorecard(_snap(spark, sf))


@register("R-02", with_ctes(["snapshot"], f"""
, common AS (SELECT ean FROM snapshot GROUP BY ean HAVING count(DISTINCT supermarket) >= 2),
pe AS (SELECT supermarket, ean, min(price) AS price, sum(CAST(round(price * 10000) AS BIGINT)) AS raw_cents
       FROM snapshot WHERE ean IN (SELECT ean FROM common) GROUP BY supermarket, ean),
b AS (SELECT supermarket, count(*) AS comparable_items,
             CAST(sum(CAST(round(price * 10000) AS BIGINT)) AS DOUBLE) / 10000.0 AS basket_cost,
             CAST(sum(raw_cents) AS DOUBLE) / 10000.0 AS basket_cost_raw
      FROM pe GROUP BY supermarket)
SELECT supermarket, comparable_items, {RND("basket_cost", 2)} AS basket_cost,
       {RND("basket_cost / min(basket_cost) OVER () * 100", 1)} AS price_index,
       {RND("basket_cost_raw", 2)} AS basket_cost_raw,
       {RND("basket_cost_raw / min(basket_cost_raw) OVER () * 100", 1)} AS price_index_raw
FROM b""".replace("\n, common", ", common", 1)))
def r02(spark, sf):
    return R.r02_competitiveness(_snap(spark, sf))


@register("R-03", with_ctes(["snapshot"], f"""
, week_before AS (
  SELECT supermarket AS shop, ltrim(trim(coalesce(ean, '')), '0') AS code,
         arg_max_null(price, ROW(collected_at, sku, region)) AS before
  FROM silver_products WHERE collected_at >= TIMESTAMP '{H_LO}' AND collected_at <= TIMESTAMP '{H_HI}'
  GROUP BY supermarket, ean),
fall AS (SELECT s.*, before, (before - price) / before AS share
         FROM week_before JOIN snapshot s ON shop = s.supermarket AND code = s.ean)
SELECT supermarket, region, sku, name AS product, before AS old_price, price AS new_price,
       {RND("share * 100", 1)} AS discount_pct
FROM fall WHERE share >= 0.10 AND price < before
ORDER BY 7 DESC, 1, 2, 3
LIMIT 100"""))
def r03(spark, sf):
    return R.r03_recent_drops(_silver(spark, sf), _snap(spark, sf), AS_OF)


@register("R-04", with_ctes(["snapshot"], f"""
SELECT ean, min(name) AS product, first(supermarket ORDER BY price, supermarket) AS cheapest_store,
       min(price) AS min_price, first(supermarket ORDER BY price DESC, supermarket DESC) AS priciest_store,
       max(price) AS max_price, {RND("(max(price) - min(price)) / min(price) * 100", 1)} AS gap_pct
FROM snapshot GROUP BY ean
HAVING count(DISTINCT supermarket) >= 2 AND gap_pct > 30"""))
def r04(spark, sf):
    return R.r04_arbitrage(_snap(spark, sf))


@register("R-05", with_ctes(["snapshot"], f"""
SELECT supermarket, count(*) FILTER (WHERE price <= 10) AS up_to_10,
       count(*) FILTER (WHERE price > 10 AND price <= 30) AS from_10_to_30,
       count(*) FILTER (WHERE price > 30) AS above_30, {RND(MAVG("price"), 2)} AS avg_price
FROM snapshot GROUP BY supermarket"""))
def r05(spark, sf):
    return R.r05_price_bands(_snap(spark, sf))


@register("R-06", with_ctes(["silver_products"], f"""
SELECT supermarket, CAST(collected_at AS DATE) AS day, region, count(*) AS volume
FROM silver_products WHERE collected_at >= TIMESTAMP '{SINCE7}'
GROUP BY supermarket, day, region"""))
def r06(spark, sf):
    return R.r06_volume_audit(_silver(spark, sf), AS_OF)


@register("R-07", with_ctes(["silver_products"], f"""
SELECT supermarket, count(DISTINCT region) AS regions, count(DISTINCT sku) AS products,
       {RND(MAVG("price"), 2)} AS avg_price, min(collected_at) AS first_collection,
       max(collected_at) AS last_collection
FROM silver_products GROUP BY supermarket"""))
def r07(spark, sf):
    return R.r07_stats(_silver(spark, sf))


ADHOC = """SELECT supermarket, region, count(*) AS observations, count(DISTINCT sku) AS products
FROM silver_products GROUP BY supermarket, region"""


@register("R-08", with_ctes(["silver_products"], ADHOC))
def r08(spark, sf):
    R.register_views(spark, _silver(spark, sf), _snap(spark, sf))
    return R.query(spark, ADHOC)


COMMON = """SELECT ean, count(DISTINCT supermarket) AS n_stores, min(price) AS min_price, max(price) AS max_price
FROM snapshot WHERE ean <> '' GROUP BY ean HAVING count(DISTINCT supermarket) >= 2
ORDER BY max(price) - min(price) DESC, ean LIMIT 20"""


@register("R-09", with_ctes(["snapshot"], COMMON))
def r09(spark, sf):
    """Documented ad-hoc query: barcodes carried by 2+ stores, widest spread first (top 20)."""
    R.register_views(spark, _silver(spark, sf), _snap(spark, sf))
    return R.query(spark, COMMON)


def _adhoc(name, table, doc, sql):
    def run(spark, sf):
        R.register_views(spark, _silver(spark, sf), _snap(spark, sf))
        return R.query(spark, sql)
    run.__doc__ = doc
    register(name, with_ctes([table], sql))(run)


_adhoc("R-09b", "snapshot", "Documented ad-hoc query: average price by store.",
       f"SELECT supermarket, count(*) AS products, {MAVG('price')} AS avg_price FROM snapshot GROUP BY supermarket")
_adhoc("R-09c", "silver_products", "Documented ad-hoc query: price history of one barcode (the first).",
       "SELECT ean, supermarket, region, sku, collected_at, price FROM silver_products "
       "WHERE ean = (SELECT min(ean) FROM silver_products WHERE ean <> '')")
_adhoc("R-09d", "silver_products", "Documented ad-hoc query: volume per day.",
       "SELECT CAST(collected_at AS DATE) AS day, supermarket, count(*) AS records FROM silver_products "
       "GROUP BY CAST(collected_at AS DATE), supermarket")


# ------------------------------------------------------------------ dashboard
P = f"scraped_date BETWEEN {_d(START)} AND {_d(END)}"


@register("D-01", with_ctes(["tru", "dim_store", "dim_region"], f"""
SELECT (SELECT count(DISTINCT product_id) FROM tru WHERE {P}) AS total_products,
       (SELECT count(DISTINCT store_name) FROM dim_store WHERE is_active) AS total_stores,
       (SELECT count(DISTINCT region_code) FROM dim_region) AS total_regions,
       (SELECT {RND(MAVG("min_price"), 2)} FROM tru WHERE min_price > 0 AND {P}) AS avg_price"""))
def d01(spark, sf):
    w = _wh(spark, sf)
    return D.d01_kpis(w.tru(), w.dim("dim_store"), w.dim("dim_region"), START, END)


@register("D-02", with_ctes(["fct_active_promotions"], f"""
SELECT count(DISTINCT product_id) AS products_on_promo, {RND(MAVG("discount_percentage"), 1)} AS avg_discount,
       count(*) FILTER (WHERE discount_percentage >= 30) AS hot_deals,
       {RND(MSUM("(regular_price - promotional_price)"), 2)} AS total_savings
FROM fct_active_promotions"""))
def d02(spark, sf):
    return D.d02_promo_kpis(_wh(spark, sf).fact("fct_active_promotions"))


@register("D-03", with_ctes(["tru", "dim_store", "fct_active_promotions"], f"""
, score AS (
  SELECT store_id, 'price_leader' AS leader, -1 AS direction, {RND(MAVG("min_price"), 2)} AS value
  FROM tru JOIN dim_store ON store_id = supermarket WHERE min_price > 0 AND {P} GROUP BY store_id
  UNION ALL
  SELECT store_id, 'promo_leader', 1, CAST(count(*) AS DOUBLE)
  FROM (SELECT DISTINCT store_key, product_id FROM fct_active_promotions) JOIN dim_store USING (store_key) GROUP BY store_id)
SELECT leader, store_name, value
FROM score JOIN dim_store USING (store_id) WHERE is_active
QUALIFY row_number() OVER (PARTITION BY leader ORDER BY value * direction DESC, store_name) = 1""".replace("\n, score", ", score", 1)))
def d03(spark, sf):
    w = _wh(spark, sf)
    return D.d03_leaders(w.tru(), w.fact("fct_active_promotions"), w.dim("dim_store"), START, END)


_CUR = f"scraped_date BETWEEN {_d(START)} AND {_d(END)}"
_PREV = f"scraped_date BETWEEN {_d(PSTART)} AND {_d(PEND)}"


@register("D-04", with_ctes(["tru"], f"""
, c AS (SELECT CAST(sum(CAST(round(min_price * 10000) AS BIGINT)) FILTER (WHERE {_CUR}) AS DOUBLE)
               / CAST(count(min_price) FILTER (WHERE {_CUR}) AS DOUBLE) / 10000.0 AS cur,
             CAST(sum(CAST(round(min_price * 10000) AS BIGINT)) FILTER (WHERE {_PREV}) AS DOUBLE)
               / CAST(count(min_price) FILTER (WHERE {_PREV}) AS DOUBLE) / 10000.0 AS prev
        FROM tru WHERE min_price > 0)
SELECT {RND("cur", 2)} AS current_avg_price, {RND("prev", 2)} AS previous_avg_price,
       {PCT("cur - prev", "prev")} AS change_pct FROM c""".replace("\n, c AS", ", c AS", 1)))
def d04(spark, sf):
    return D.d04_period_change(_wh(spark, sf).tru(), START, END)


@register("D-05", with_ctes(["tru", "dim_store"], f"""
SELECT s.store_name, {RND(MAVG("p.min_price"), 2)} AS avg_price, count(DISTINCT p.product_id) AS product_count
FROM tru p JOIN dim_store s ON p.supermarket = s.store_id
WHERE p.min_price > 0 AND p.{P} AND s.is_active GROUP BY s.store_name"""))
def d05(spark, sf):
    w = _wh(spark, sf)
    return D.d05_store_comparison(w.tru(), w.dim("dim_store"), START, END)


@register("D-05b", with_ctes(["tru"], f"""
SELECT scraped_date, {RND(MAVG("min_price"), 2)} AS avg_price FROM tru
WHERE min_price > 0 AND {P} GROUP BY scraped_date"""))
def d05b(spark, sf):
    return D.d05_price_evolution(_wh(spark, sf).tru(), START, END)


@register("D-05c", with_ctes(["fct_active_promotions", "dim_store"], f"""
SELECT ds.store_name, count(DISTINCT ap.product_id) AS products_on_promo,
       {RND(MAVG("ap.discount_percentage"), 1)} AS avg_discount
FROM fct_active_promotions ap JOIN dim_store ds ON ap.store_key = ds.store_key
WHERE ds.is_active GROUP BY ds.store_name"""))
def d05c(spark, sf):
    w = _wh(spark, sf)
    return D.d05_promo_by_store(w.fact("fct_active_promotions"), w.dim("dim_store"))


@register("D-06", with_ctes(["tru"], f"""
, daily AS (SELECT scraped_date, {MAVG("min_price")} AS avg_price FROM tru
            WHERE min_price > 0 AND {P} GROUP BY scraped_date),
l AS (SELECT scraped_date, avg_price, lag(avg_price) OVER (ORDER BY scraped_date) AS prev FROM daily)
SELECT scraped_date, {RND("avg_price", 2)} AS avg_price, {RND("prev", 2)} AS prev_avg_price,
       {RND("avg_price - prev", 2)} AS change,
       CASE WHEN prev IS NULL THEN NULL WHEN avg_price - prev > 0 THEN 'up'
            WHEN avg_price - prev < 0 THEN 'down' ELSE 'flat' END AS direction
FROM l""".replace("\n, daily AS", ", daily AS", 1)))
def d06(spark, sf):
    return D.d06_direction(_wh(spark, sf).tru(), START, END)


@register("D-06b", with_ctes(["tru", "fct_active_promotions"], f"""
, t AS (SELECT count(DISTINCT product_id) AS total_products FROM tru WHERE {P}),
p AS (SELECT count(DISTINCT product_id) AS products_on_promo FROM fct_active_promotions)
SELECT total_products, products_on_promo,
       {RND("CAST(products_on_promo AS DOUBLE) / greatest(total_products, 1) * 100", 1)} AS promo_penetration_pct
FROM t, p""".replace("\n, t AS", ", t AS", 1)))
def d06b(spark, sf):
    w = _wh(spark, sf)
    return D.d06_penetration(w.tru(), w.fact("fct_active_promotions"), START, END)


@register("D-07", with_ctes(["tru"], f"""
SELECT count(*) FILTER (WHERE {P}) AS rows_in_period,
       count(DISTINCT scraped_date) FILTER (WHERE {P}) AS days_with_data,
       CAST({(END - START).days + 1} AS BIGINT) AS days_in_period,
       max(scraped_date) AS latest_scrape, count(*) AS total_rows, count(DISTINCT product_id) AS total_products
FROM tru"""))
def d07(spark, sf):
    return D.d07_coverage(_wh(spark, sf).tru(), START, END)


@register("D-08", with_ctes(["fct_daily_prices", "dim_store"], """
SELECT s.store_name AS supermarket, p.product_id, p.region, p.scraped_date, p.min_price
FROM fct_daily_prices p JOIN dim_store s ON s.store_key = p.store_key
WHERE s.store_id IN ('bistek', 'fort', 'giassi') AND p.min_price BETWEEN 1 AND 500"""))
def d08(spark, sf):
    w = _wh(spark, sf)
    return D.d08_price_rows(w.fact("fct_daily_prices"), w.dim("dim_store"))


@register("D-08b", with_ctes(["fct_active_promotions", "dim_store"], f"""
SELECT p.product_id, p.product_name, s.store_name AS supermarket, p.region, p.scraped_date,
       {RND("p.promotional_price", 2)} AS promo_price, {RND("p.discount_percentage", 1)} AS discount_pct
FROM fct_active_promotions p JOIN dim_store s ON s.store_key = p.store_key WHERE p.discount_percentage >= 30"""))
def d08b(spark, sf):
    w = _wh(spark, sf)
    return D.d08_promotions(w.fact("fct_active_promotions"), w.dim("dim_store"))


@register("D-08c", with_ctes(["fct_price_comparison_v2"], """
SELECT product_id, product_name, count(DISTINCT store_key) AS store_count, min(min_price) AS lowest_price, max(min_price) AS highest_price
FROM fct_price_comparison_v2 GROUP BY product_id, product_name HAVING count(DISTINCT store_key) >= 2"""))
def d08c(spark, sf):
    return D.d08_competitiveness(_wh(spark, sf).fact("fct_price_comparison_v2"))

