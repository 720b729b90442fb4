"""Registered queries: page and sitemap extraction (SRC-14 .. SRC-20), deal
re-checks (V-01 .. V-03), discovery (DSC-01 .. DSC-05)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import config
from ..plans import deal_checks as DC
from ..plans.warehouse import warehouse
from ..sources import adapter
from ..sources import pages as P
from .oracle import STORES, register as cte, with_ctes
from .registry import register

AS_OF = config.DEFAULT_AS_OF

_MONEY = "printf('%d.%02d', {c} // 100, {c} % 100)"
_BR = "translate(format('{{:,.2f}}', {c} / 100.0), ',.', '.,')"


def money(c):
    return _MONEY.format(c=c)


def br(c):
    return _BR.format(c=c)


cte("pages", f"""
pages AS (
  WITH p AS (
    SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS ks, p_name, p_brand,
           ({STORES})[p_partkey % 5 + 1] AS store,
           CAST(round(p_retailprice * 100) AS BIGINT) AS list_c,
           CAST(round(p_retailprice * 100) AS BIGINT) * (10 - p_partkey % 4) // 10 AS price_c
    FROM part),
  q AS (
    SELECT *, 'https://www.' || store || '.com.br/' || replace(lower(p_name), ' ', '-') || '-' || ks || '/p' AS url,
           lpad(ks, 13, '0') AS ean,
           '{{"@type":"Offer","price":"' || {money("price_c")} || '","highPrice":"' || {money("list_c")}
             || '","priceCurrency":"BRL","availability":"https://schema.org/'
             || CASE WHEN k % 7 = 0 THEN 'OutOfStock' ELSE 'InStock' END || '"}}' AS offer
    FROM p),
  r AS (
    SELECT *, '{{"@context":"https://schema.org","@type":"Product","name":"' || p_name || '","sku":"' || ks
             || '","gtin13":"' || ean || '","brand":'
             || CASE WHEN k % 2 = 0 THEN '{{"@type":"Brand","name":"' || p_brand || '"}}' ELSE '"' || p_brand || '"' END
             || ',"image":' || CASE WHEN k % 2 = 1 THEN '["http://img.example/' || ks || '.jpg"]'
                                    ELSE '"http://img.example/' || ks || '.jpg"' END
             || ',"offers":' || CASE WHEN k % 3 = 0 THEN '[' || offer || ']' ELSE offer END || '}}' AS product0
    FROM q),
  s AS (
    SELECT *, CASE WHEN k % 13 = 0 THEN substring(product0, 1, 60) ELSE product0 END AS product FROM r)
  SELECT k + 1000000000 AS page_id, url,
    '<html><head><title>' || p_name || '</title>'
    || CASE WHEN k % 17 = 0 THEN '' ELSE
         '<script type="application/ld+json">{{"@context":"https://schema.org","@type":"BreadcrumbList"}}</script>'
         || '<script type="application/ld+json">' || product || '</script>' END
    || '</head><body><h1 class="product-name">' || p_name || '</h1>'
    || '<div itemscope itemtype="https://schema.org/Product"><meta itemprop="name" content="' || p_name
    || '"><meta itemprop="brand" content="' || p_brand || '"><meta itemprop="gtin13" content="' || ean
    || '"><meta itemprop="price" content="' || {money("price_c")} || '"></div>'
    || '<div class="price-selling">R$ ' || {br("price_c")} || '</div><div class="price-list">R$ ' || {br("list_c")}
    || '</div></body></html>' AS html, 200 AS status
  FROM s
  UNION ALL
  SELECT page_id, url, html, 200 FROM main.pages
)""", [])

LD = r'<script[^>]*application/ld\+json[^>]*>(.*?)</script>'


def J(path):
    return f"CASE WHEN json_valid(block) THEN json_extract_string(block, '{path}') END"


cte("ld", f"""
ld AS (
  WITH b AS (
    SELECT page_id, url, unnest(regexp_extract_all(html, '{LD}', 1)) AS block,
           unnest(range(1, len(regexp_extract_all(html, '{LD}', 1)) + 1)) AS pos
    FROM pages)
  SELECT page_id, url, arg_min(block, pos) AS block FROM b
  WHERE {J('$."@type"')} = 'Product' GROUP BY page_id, url
)""", ["pages"])

cte("ld_norm", f"""
ld_norm AS (
  SELECT page_id, url,
    coalesce({J('$.sku')}, nullif(regexp_extract(url, '-(\\d+)/p$', 1), '')) AS product_id,
    {J('$.name')} AS name,
    coalesce({J('$.brand.name')}, {J('$.brand')}) AS brand,
    TRY_CAST(coalesce({J('$.offers.price')}, {J('$.offers[0].price')}) AS DOUBLE) AS price,
    TRY_CAST(coalesce({J('$.offers.highPrice')}, {J('$.offers[0].highPrice')}) AS DOUBLE) AS list_price,
    {J('$.gtin13')} AS ean,
    regexp_replace(coalesce({J('$.image[0]')}, {J('$.image')}), '^http://', 'https://') AS image_url,
    coalesce(contains(coalesce({J('$.offers.availability')}, {J('$.offers[0].availability')}), 'InStock'), false) AS available,
    CASE WHEN coalesce(contains(coalesce({J('$.offers.availability')}, {J('$.offers[0].availability')}), 'InStock'), false)
         THEN 999 ELSE 0 END AS stock,
    {J('$.name')} IS NULL AS malformed
  FROM ld
)""", ["ld"])


def price_text(x):
    s = f"regexp_replace({x}, '[^0-9,.]', '', 'g')"
    t = f"CASE WHEN position(',' IN {s}) > 0 THEN replace(replace({s}, '.', ''), ',', '.') ELSE {s} END"
    return f"TRY_CAST(nullif({t}, '') AS DOUBLE)"


cte("css", f"""
css AS (
  SELECT * FROM (
    SELECT page_id, url, nullif(trim(regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1)), '') AS name,
           {price_text("regexp_extract(html, 'class=\"price-selling\"[^>]*>([^<]*)<', 1)")} AS price,
           {price_text("regexp_extract(html, 'class=\"price-list\"[^>]*>([^<]*)<', 1)")} AS list_price
    FROM pages)
  WHERE name IS NOT NULL AND price > 0
)""", ["pages"])


def _pages(spark, sf):
    return adapter.product_pages(spark, sf)


@register("SRC-15", with_ctes(["ld"], "SELECT page_id, url, block FROM ld"))
def src15(spark, sf):
    return P.jsonld_products(_pages(spark, sf))


@register("SRC-20", with_ctes(["ld_norm"], "SELECT * FROM ld_norm"))
def src20(spark, sf):
    return P.normalize_jsonld(P.jsonld_products(_pages(spark, sf)))


def _mp(name):
    return f"nullif(regexp_extract(html, 'itemprop=\"{name}\"[^>]*content=\"([^\"]*)\"', 1), '')"


@register("SRC-16", with_ctes(["pages"], f"""
SELECT * FROM (
  SELECT page_id, url, {_mp('name')} AS name, {_mp('brand')} AS brand, {_mp('category')} AS category,
         TRY_CAST({_mp('price')} AS DOUBLE) AS price, coalesce({_mp('gtin13')}, {_mp('gtin14')}, {_mp('gtin')}) AS ean,
         {_mp('image')} AS image_url, {_mp('availability')} AS availability
  FROM pages)
WHERE name IS NOT NULL OR price IS NOT NULL"""))
def src16(spark, sf):
    return P.microdata(_pages(spark, sf))


@register("SRC-17", with_ctes(["css"], "SELECT * FROM css"))
def src17(spark, sf):
    return P.css_prices(_pages(spark, sf))


cte("live", """
live AS (
  SELECT p.page_id, p.url, p.status,
         CASE WHEN l.price IS NOT NULL THEN l.price ELSE c.price END AS live_price,
         CASE WHEN (CASE WHEN l.price IS NOT NULL THEN l.price ELSE c.price END) IS NOT NULL THEN
           CASE WHEN (CASE WHEN l.price IS NOT NULL THEN l.list_price ELSE c.list_price END)
                     > (CASE WHEN l.price IS NOT NULL THEN l.price ELSE c.price END)
                THEN ((CASE WHEN l.price IS NOT NULL THEN l.list_price ELSE c.list_price END)
                      - (CASE WHEN l.price IS NOT NULL THEN l.price ELSE c.price END))
                     / (CASE WHEN l.price IS NOT NULL THEN l.list_price ELSE c.list_price END) * 100
                ELSE 0 END END AS live_discount_pct,
         CASE WHEN l.price IS NOT NULL THEN 'jsonld' WHEN c.price IS NOT NULL THEN 'css' END AS source
  FROM pages p
  LEFT JOIN (SELECT page_id, price, list_price FROM ld_norm) l ON p.page_id = l.page_id
  LEFT JOIN (SELECT page_id, price, list_price FROM css) c ON p.page_id = c.page_id
)""", ["ld_norm", "css"])


@register("SRC-18", with_ctes(["live"], "SELECT * FROM live"))
def src18(spark, sf):
    return P.live_prices(_pages(spark, sf))


cte("sitemap_urls", f"""
sitemap_urls AS (
  WITH d AS (
    SELECT p_partkey AS sitemap_id, replace(lower(p_name), ' ', '-') AS slug,
           CASE WHEN p_partkey % 11 = 0 THEN ''
                WHEN p_partkey % 19 = 0 THEN '<lastmod>not-a-date</lastmod>'
                ELSE '<lastmod>' || strftime(DATE '2026-03-01' - CAST(p_partkey % 60 AS INTEGER), '%Y-%m-%d')
                     || '</lastmod>' END AS lm
    FROM part),
  x AS (
    SELECT sitemap_id, '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
      || {" || ".join(f"'<url><loc>https://www.{s}.com.br/' || slug || '-' || CAST(sitemap_id AS VARCHAR) || '/p</loc>' || lm || '</url>'" for s in config.ADAPTER_STORES)}
      || '<url><loc>https://www.bistek.com.br/category/' || slug || '</loc></url></urlset>' AS xml
    FROM d),
  e AS (SELECT sitemap_id, unnest(regexp_extract_all(xml, '<url>(.*?)</url>', 1)) AS entry FROM x),
  u AS (SELECT sitemap_id, regexp_extract(entry, '<loc>([^<]*)</loc>', 1) AS url,
               nullif(regexp_extract(entry, '<lastmod>([^<]*)</lastmod>', 1), '') AS lastmod_text FROM e)
  SELECT sitemap_id, url, regexp_extract(url, '-(\\d+)/p$', 1) AS product_id,
         regexp_extract(url, 'https?://(?:www\\.)?([^./]+)', 1) AS store, lastmod_text,
         TRY_CAST(lastmod_text AS DATE) AS lastmod
  FROM u WHERE regexp_matches(url, '-(\\d+)/p$')
)""", [])


def _sitemap(spark, sf):
    return P.sitemap_urls(adapter.sitemaps(spark, sf))


@register("SRC-14", with_ctes(["sitemap_urls"], "SELECT * FROM sitemap_urls"))
def src14(spark, sf):
    return _sitemap(spark, sf)


# ------------------------------------------------------------------ discovery
LOOKBACK = 14
SINCE = AS_OF - dt.timedelta(days=LOOKBACK)


@register("DSC-02", with_ctes(["sitemap_urls"], f"""
SELECT * FROM sitemap_urls WHERE lastmod IS NULL OR lastmod >= DATE '{SINCE.isoformat()}'"""))
def dsc02(spark, sf):
    """Incremental discovery: lastmod within the lookback, missing or invalid dates kept."""
    return DC.incremental_by_lastmod(_sitemap(spark, sf), SINCE)


@register("DSC-01", with_ctes(["sitemap_urls", "obs"], f"""
SELECT s.* FROM sitemap_urls s
WHERE s.url NOT IN (SELECT product_url FROM obs
                    WHERE CAST(scraped_at AS DATE) = (SELECT max(CAST(scraped_at AS DATE)) FROM obs))"""))
def dsc01(spark, sf):
    """New-only discovery: sitemap URLs not collected in the latest run day."""
    return DC.new_only(_sitemap(spark, sf), warehouse(spark, sf).stg())


@register("DSC-03", with_ctes(["sitemap_urls"], f"""
SELECT *, regexp_matches(url, '-1[0-9]*/p$') AS priority FROM sitemap_urls
WHERE priority OR left(md5(url || '|42'), 8) < '{DC.sample_bound(0.1)}'"""))
def dsc03(spark, sf):
    """Sampling: priority URLs plus a deterministic hash sample of the rest."""
    return DC.sample_urls(_sitemap(spark, sf), priority=[r"-1\d*/p$"], rate=0.1, seed=42)


cte("failed_urls", f"""
failed_urls AS (
  SELECT url, TIMESTAMP '2026-03-01 00:00:00' - to_days(CAST(page_id % 20 AS INTEGER)) AS failed_at,
         CASE WHEN page_id % 2 = 0 THEN 404 ELSE 500 END AS status
  FROM (SELECT page_id, url FROM main.pages UNION ALL
        SELECT p_partkey, 'https://www.' || ({STORES})[p_partkey % 5 + 1] || '.com.br/' || replace(lower(p_name), ' ', '-') || '-'
               || CAST(p_partkey AS VARCHAR) || '/p'
        FROM part WHERE p_partkey % 9 = 0)
)""", [])


@register("DSC-04", with_ctes(["sitemap_urls", "failed_urls"], """
SELECT s.* FROM sitemap_urls s
WHERE s.url NOT IN (SELECT url FROM failed_urls WHERE failed_at >= TIMESTAMP '2026-02-22 00:00:00')"""))
def dsc04(spark, sf):
    """Failed-URL cache with a 7-day TTL: fresh failures are excluded from the crawl list."""
    return DC.exclude_cached_failures(_sitemap(spark, sf), DC.failed_urls(spark, sf),
                                      dt.datetime(2026, 3, 1), ttl_days=7)


@register("DSC-05", with_ctes(["failed_urls"], """
SELECT CASE WHEN age_days <= 1 THEN '0-1' WHEN age_days <= 3 THEN '2-3' WHEN age_days <= 7 THEN '4-7' ELSE '>7' END
         AS age_band,
       count(*) AS urls, count(*) FILTER (WHERE age_days <= 7) AS valid, count(*) FILTER (WHERE age_days > 7) AS expired,
       min(failed_at) AS oldest, max(failed_at) AS newest
FROM (SELECT *, date_diff('day', CAST(failed_at AS DATE), DATE '2026-03-01') AS age_days FROM failed_urls)
GROUP BY age_band"""))
def dsc05(spark, sf):
    return DC.failed_url_stats(DC.failed_urls(spark, sf), dt.date(2026, 3, 1), ttl_days=7)


# ------------------------------------------------------------------ deal re-checks
cte("deals", f"""
deals AS (
  WITH u AS (SELECT product_id, supermarket, min(product_url) AS product_url FROM tru GROUP BY product_id, supermarket)
  SELECT h.product_id, h.supermarket, h.region, h.scraped_date, h.promotional_price AS expected_price,
         h.discount_percentage AS expected_discount, u.product_url
  FROM fct_hot_deals_validated h LEFT JOIN u ON h.product_id = u.product_id AND h.supermarket = u.supermarket
  WHERE h.scraped_date = DATE '{AS_OF.isoformat()}' AND h.discount_percentage >= 30
)""", ["fct_hot_deals_validated", "tru"])


@register("V-02", with_ctes(["deals"], "SELECT * FROM deals"))
def v02(spark, sf):
    w = warehouse(spark, sf)
    return DC.select_deals(w.fact("fct_hot_deals_validated"), w.tru(), AS_OF, min_discount=30)


cte("rechecks", """
rechecks AS (
  SELECT d.*, l.live_price, l.live_discount_pct,
         CASE WHEN d.product_url IS NULL THEN 'no_url'
              WHEN l.url IS NULL OR l.status <> 200 OR l.live_price IS NULL THEN 'error'
              WHEN l.live_price <= d.expected_price * 1.05 AND l.live_discount_pct >= d.expected_discount * 0.90
                THEN 'active' ELSE 'expired' END AS status
  FROM deals d LEFT JOIN (SELECT * FROM live QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1) l
    ON d.product_url = l.url
)""", ["deals", "live"])


@register("V-01", with_ctes(["rechecks"], "SELECT * FROM rechecks"))
def v01(spark, sf):
    w = warehouse(spark, sf)
    deals = DC.select_deals(w.fact("fct_hot_deals_validated"), w.tru(), AS_OF, min_discount=30)
    return DC.recheck(deals, P.live_prices(_pages(spark, sf)))


@register("V-03", with_ctes(["rechecks"], """
SELECT status, count(*) AS deals, CAST(round(CAST(count(*) * 100.0 / sum(count(*)) OVER () AS DECIMAL(38,6)), 1) AS DOUBLE)
       AS pct
FROM rechecks GROUP BY status"""))
def v03(spark, sf):
    w = warehouse(spark, sf)
    deals = DC.select_deals(w.fact("fct_hot_deals_validated"), w.tru(), AS_OF, min_discount=30)
    return DC.outcome_stats(DC.recheck(deals, P.live_prices(_pages(spark, sf))))


_ = F


@register("SRC-19", with_ctes([], """
SELECT p_partkey AS doc_id, CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name,
       (CAST(round(p_retailprice * 100) AS BIGINT) * 9 // 10) / 100.0 AS price,
       CASE WHEN p_partkey % 2 = 0 THEN p_retailprice ELSE (CAST(round(p_retailprice * 100) AS BIGINT) * 9 // 10) / 100.0 END AS list_price,
       p_size AS stock, 'https://img.example/' || CAST(p_partkey AS VARCHAR) AS image_url,
       CASE WHEN p_partkey % 2 = 0 THEN p_type || '|All' ELSE p_type END AS categories
FROM part"""))
def src19(spark, sf):
    """GraphQL product normalisation (two response variants) -> flat rows."""
    g = P.graphql_products(adapter.graphql_documents(spark, sf))
    return g.withColumn("categories", F.array_join("categories", "|"))
