"""DuckDB twins of the registered queries.

Written independently of the Spark code, in the reference's own style
(QUALIFY, unnest + GROUP BY, list aggregates), over the driver's tables which
DuckDB sees as views. Shared CTEs are composed with ``with_ctes``.
"""

from __future__ import annotations

from .. import config


def _arr(values) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + "]"


STORES = _arr(config.ADAPTER_STORES)
REGIONS = _arr(config.ADAPTER_REGIONS)
POSTALS = _arr([r[1] for r in config.REGION_SEED])
HUBS = _arr([r[3] for r in config.REGION_SEED])

CTE: dict[str, str] = {}

CTE["offers"] = f"""
offers AS (
  SELECT
    CAST(l_partkey AS VARCHAR) AS product_id,
    CASE WHEN l_suppkey % 5 = 1 THEN upper(p_name) WHEN l_suppkey % 5 = 3 THEN replace(p_name, ' ', '  ')
         WHEN l_suppkey % 5 = 4 AND l_partkey % 17 = 0 THEN p_name || ' giassi ' || CAST(l_partkey AS VARCHAR)
         ELSE p_name END AS product_name,
    CASE WHEN l_partkey % 11 <> 0 THEN p_brand END AS brand,
    'https://www.' || ({STORES})[l_suppkey % 5 + 1] || '.com.br/' || replace(lower(p_name), ' ', '-') || '-' || CAST(l_partkey AS VARCHAR) || '/p' AS product_url,
    ({STORES})[l_suppkey % 5 + 1] AS supermarket,
    ({REGIONS})[l_orderkey % 8 + 1] AS region,
    ({POSTALS})[l_orderkey % 8 + 1] AS postal_code,
    ({HUBS})[l_orderkey % 8 + 1] AS hub_id,
    CAST(DATE '2026-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 60 AS INTEGER) AS TIMESTAMP)
      + to_hours(CAST(l_linenumber AS BIGINT)) AS scraped_at,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS item_id,
    p_name || ' ' || CAST(p_size AS VARCHAR) || 'g' AS item_name,
    CASE WHEN l_partkey % 3 <> 0 THEN lpad(CAST(l_partkey AS VARCHAR), 13, '0') END AS ean,
    CAST(l_suppkey AS VARCHAR) AS seller_id,
    l_linenumber AS line_number,
    ((CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT))
      * (100 - CAST(round(l_discount * 100) AS BIGINT) * (l_partkey % 10)) // 100) / 100.0 AS price,
    (CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)) / 100.0 AS list_price,
    CAST(l_quantity AS INTEGER) - 3 AS available_quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

CTE["obs"] = """
obs AS (
  SELECT *, supermarket || '_' || strftime(scraped_at, '%Y%m%d%H') AS run_id FROM offers
)"""

# latest landed record per product x store x region x day (one record per offer row)
CTE["latest"] = """
latest AS (
  SELECT * FROM obs
  QUALIFY row_number() OVER (
    PARTITION BY product_id, supermarket, region, CAST(scraped_at AS DATE)
    ORDER BY scraped_at DESC, run_id DESC, item_id DESC) = 1
)"""

# SKUs of the surviving records: the row's SKU plus a two-pack on even line numbers
CTE["skus"] = """
skus AS (
  SELECT product_id, product_name, brand, product_url, supermarket, region, postal_code, hub_id,
         run_id, scraped_at, item_id AS sku_id, ean, price, list_price, available_quantity
  FROM latest
  UNION ALL
  SELECT product_id, product_name, brand, product_url, supermarket, region, postal_code, hub_id,
         run_id, scraped_at, item_id || '-x2', NULL, price * 2, list_price * 2,
         CAST(floor(available_quantity / 2) AS INTEGER)
  FROM latest WHERE line_number % 2 = 0
)"""

CTE["tru"] = """
tru AS (
  SELECT
    product_id, any_value(product_name) AS product_name, any_value(brand) AS brand,
    any_value(product_url) AS product_url, supermarket, region,
    any_value(postal_code) AS postal_code, any_value(hub_id) AS hub_id,
    min(price) AS min_price, max(price) AS max_price,
    CAST(sum(CAST(round(price * 10000) AS BIGINT)) AS DOUBLE) / CAST(count(price) AS DOUBLE) / 10000.0 AS avg_price,
    min(list_price) AS min_list_price,
    count(DISTINCT sku_id) AS sku_count,
    list(DISTINCT ean ORDER BY ean) FILTER (WHERE ean IS NOT NULL) AS eans,
    coalesce(bool_or(available_quantity > 0), false) AS is_available,
    CAST(sum(available_quantity) AS BIGINT) AS total_available_quantity,
    any_value(run_id) AS run_id,
    CAST(scraped_at AS DATE) AS scraped_date,
    max(scraped_at) AS scraped_at
  FROM skus
  GROUP BY product_id, supermarket, region, CAST(scraped_at AS DATE)
)"""

DEPS: dict[str, list[str]] = {
    "offers": [],
    "obs": ["offers"],
    "latest": ["obs"],
    "skus": ["latest"],
    "tru": ["skus"],
}


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in DEPS.get(n, []):
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(names: list[str], body: str) -> str:
    """``WITH <names and their dependencies> <body>``."""
    parts = [CTE[n].strip() for n in _order(names)]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body.strip()


def register(name: str, sql: str, deps: list[str]) -> None:
    CTE[name] = sql
    DEPS[name] = deps


# ----------------------------------------------------------------- dimensions
def _case(expr: str, pairs, default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs)
    return f"CASE {expr} {whens} ELSE {default} END"


def _values(rows, cols: str) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, (int, float)):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({cols})"


register("refraw", """
refraw AS (
  SELECT CASE WHEN p_partkey % 7 = 0 THEN lpad(CAST(p_partkey AS VARCHAR), 12, '0')
              ELSE lpad(CAST(p_partkey AS VARCHAR), 13, '0') END AS code,
         '  ' || p_name || ' ' AS product_name, p_brand || ' ' AS brands, p_type AS categories,
         CAST(p_size AS VARCHAR) || ' g' AS quantity, 'Brasil' AS countries,
         (['A','B','C','D','E','F'])[p_partkey % 6 + 1] AS nutriscore_grade,
         'ref_2026_02' AS run_id, '2026-02-01T00:00:00' AS scraped_at
  FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 2 = 0
  UNION ALL
  SELECT CASE WHEN p_partkey % 7 = 0 THEN lpad(CAST(p_partkey AS VARCHAR), 12, '0')
              ELSE lpad(CAST(p_partkey AS VARCHAR), 13, '0') END,
         'old ' || p_name, p_brand || ' ', p_type, CAST(p_size AS VARCHAR) || ' g', 'Brasil',
         (['A','B','C','D','E','F'])[p_partkey % 6 + 1], 'ref_2026_01', '2026-01-01T00:00:00'
  FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 2 = 0 AND p_partkey % 4 = 0
)""", [])

register("stg_ref", """
stg_ref AS (
  SELECT code AS ean_code, trim(product_name) AS product_name, trim(brands) AS brands, categories,
         quantity, countries, lower(nutriscore_grade) AS nutriscore_grade, run_id,
         CAST(scraped_at AS TIMESTAMP) AS scraped_at
  FROM refraw WHERE code IS NOT NULL AND length(code) IN (8, 13, 14)
)""", ["refraw"])

_DESC = _case("store_type", config.STORE_TYPE_DESCRIPTION.items(), "'Unknown'")
register("dim_store", f"""
dim_store AS (
  SELECT row_number() OVER (ORDER BY store_id) AS store_key, store_id, store_name, store_type,
         coverage_states, is_active, CAST(region_count AS INTEGER) AS region_count, website_url,
         {_DESC} AS store_type_description,
         CASE WHEN store_type IN ('hypermarket', 'supermarket') THEN 'B2C'
              WHEN store_type = 'wholesale' THEN 'B2B/B2C' ELSE 'Unknown' END AS business_segment
  FROM {_values(config.STORE_SEED, "store_id, store_name, store_type, coverage_states, is_active, region_count, website_url")}
)""", [])

register("region_seed", f"""
region_seed AS (
  SELECT * FROM {_values([(s, r, *v) for s, rs in config.STORE_REGIONS.items() for r, v in rs.items()],
                          "store, region_code, postal_code, sc_code, hub_id")}
)""", [])

AS_OF = f"DATE '{config.DEFAULT_AS_OF.isoformat()}'"
register("dim_date", f"""
dim_date AS (
  SELECT date_day,
    CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_key,
    extract(day FROM date_day) AS day_of_month,
    extract(dow FROM date_day) AS day_of_week,
    strftime(date_day, '%A') AS day_name, strftime(date_day, '%a') AS day_name_short,
    extract(doy FROM date_day) AS day_of_year,
    extract(week FROM date_day) AS week_of_year,
    date_trunc('week', date_day)::DATE AS week_start_date,
    (date_trunc('week', date_day) + INTERVAL '6 days')::DATE AS week_end_date,
    extract(month FROM date_day) AS month_of_year,
    strftime(date_day, '%B') AS month_name, strftime(date_day, '%b') AS month_name_short,
    date_trunc('month', date_day)::DATE AS month_start_date,
    (date_trunc('month', date_day) + INTERVAL '1 month' - INTERVAL '1 day')::DATE AS month_end_date,
    strftime(date_day, '%Y-%m') AS year_month,
    extract(quarter FROM date_day) AS quarter_of_year,
    'Q' || extract(quarter FROM date_day) AS quarter_name,
    date_trunc('quarter', date_day)::DATE AS quarter_start_date,
    (date_trunc('quarter', date_day) + INTERVAL '3 months' - INTERVAL '1 day')::DATE AS quarter_end_date,
    extract(year FROM date_day) AS year,
    date_trunc('year', date_day)::DATE AS year_start_date,
    (date_trunc('year', date_day) + INTERVAL '1 year' - INTERVAL '1 day')::DATE AS year_end_date,
    extract(dow FROM date_day) IN (0, 6) AS is_weekend,
    extract(dow FROM date_day) BETWEEN 1 AND 5 AS is_weekday,
    CASE WHEN extract(month FROM date_day) >= 4 THEN extract(year FROM date_day)
         ELSE extract(year FROM date_day) - 1 END AS fiscal_year,
    date_day = {AS_OF} AS is_today,
    date_day = {AS_OF} - INTERVAL '1 day' AS is_yesterday,
    date_day BETWEEN {AS_OF} - INTERVAL '7 days' AND {AS_OF} AS is_last_7_days,
    date_day BETWEEN {AS_OF} - INTERVAL '30 days' AND {AS_OF} AS is_last_30_days,
    date_day BETWEEN date_trunc('month', {AS_OF}) AND {AS_OF} AS is_month_to_date,
    date_day BETWEEN date_trunc('year', {AS_OF}) AND {AS_OF} AS is_year_to_date
  FROM (SELECT unnest(generate_series((SELECT min(scraped_date) FROM tru), {AS_OF} + INTERVAL '2 years',
                                      INTERVAL '1 day'))::DATE AS date_day)
)""", ["tru"])

register("dim_product", """
dim_product AS (
  WITH names AS (
    SELECT product_id, product_name FROM (
      SELECT product_id, product_name, count(*) AS c FROM tru WHERE product_name IS NOT NULL GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY c DESC, product_name) = 1),
  brands AS (
    SELECT product_id, brand FROM (
      SELECT product_id, brand, count(*) AS c FROM tru WHERE brand IS NOT NULL GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY c DESC, brand) = 1),
  agg AS (
    SELECT product_id, list(DISTINCT supermarket ORDER BY supermarket) AS stores_carrying,
           count(DISTINCT supermarket) AS store_count, count(DISTINCT region) AS region_count,
           min(product_url) AS sample_url
    FROM tru GROUP BY product_id)
  SELECT row_number() OVER (ORDER BY a.product_id) AS product_key, a.product_id, n.product_name, b.brand,
         a.stores_carrying, a.store_count, a.region_count, a.sample_url
  FROM agg a LEFT JOIN names n USING (product_id) LEFT JOIN brands b USING (product_id)
)""", ["tru"])

register("dim_brand", f"""
dim_brand AS (
  SELECT row_number() OVER (ORDER BY product_count DESC, brand) AS brand_key, brand AS brand_name,
         product_count, store_count,
         CASE WHEN product_count >= 100 THEN 'Major Brand' WHEN product_count >= 20 THEN 'Medium Brand'
              WHEN product_count >= 5 THEN 'Small Brand' ELSE 'Niche Brand' END AS brand_tier,
         CASE WHEN store_count >= {len(config.STORE_SEED)} THEN 'All Stores' WHEN store_count >= 2 THEN 'Multi-store'
              ELSE 'Single Store' END AS distribution_level,
         first_seen_date, last_seen_date
  FROM (SELECT brand, count(DISTINCT product_id) AS product_count, count(DISTINCT supermarket) AS store_count,
               min(scraped_date) AS first_seen_date, max(scraped_date) AS last_seen_date
        FROM tru WHERE brand IS NOT NULL GROUP BY brand)
)""", ["tru"])

_RCITY = _case("split_part(region_code, '_', 1)", config.REGION_CITY_NAMES, "split_part(region_code, '_', 1)")
_RS = ", ".join(f"'{x}'" for x in config.REGION_RS_CITIES)
_MAJOR = ", ".join(f"'{x}'" for x in config.MAJOR_CITIES)
register("dim_region", f"""
dim_region AS (
  SELECT row_number() OVER (ORDER BY region_code) AS region_key, region_code,
         split_part(region_code, '_', 1) AS city_code, {_RCITY} AS city_name,
         split_part(region_code, '_', 2) AS neighborhood_code,
         CASE WHEN split_part(region_code, '_', 1) IN ({_RS}) THEN 'RS' ELSE 'SC' END AS state_code,
         CASE WHEN split_part(region_code, '_', 1) IN ({_RS}) THEN 'Rio Grande do Sul' ELSE 'Santa Catarina' END AS state_name,
         postal_codes, stores_in_region, store_count,
         CASE WHEN {_RCITY} IN ({_MAJOR}) THEN 'Capital/Major City'
              WHEN store_count >= 2 THEN 'Multi-store Market' ELSE 'Single-store Market' END AS market_type
  FROM (SELECT region AS region_code,
               list(DISTINCT postal_code ORDER BY postal_code) FILTER (WHERE postal_code IS NOT NULL) AS postal_codes,
               list(DISTINCT supermarket ORDER BY supermarket) AS stores_in_region,
               count(DISTINCT supermarket) AS store_count
        FROM tru WHERE region IS NOT NULL GROUP BY region)
)""", ["tru"])

_LCITY = _case("city_code", config.LOCATION_CITY_NAMES, "upper(replace(city_code, '_', ' '))")
_LNB = _case("neighborhood_code", config.LOCATION_NEIGHBORHOOD_NAMES, "upper(replace(neighborhood_code, '_', ' '))")
_LRS = ", ".join(f"'{x}'" for x in config.LOCATION_RS_CITIES)
_CITYKEYS = _values([(k,) for k, _ in config.LOCATION_CITY_NAMES], "k")
register("dim_location", f"""
dim_location AS (
  WITH ids AS (SELECT DISTINCT region AS location_id FROM tru WHERE region IS NOT NULL),
  matched AS (
    SELECT location_id,
           (SELECT k FROM {_CITYKEYS} WHERE location_id = k OR starts_with(location_id, k || '_')
            ORDER BY length(k) DESC LIMIT 1) AS m
    FROM ids),
  parsed AS (
    SELECT location_id,
      coalesce(m, CASE WHEN position('_' IN location_id) > 0
                       THEN left(location_id, position('_' IN location_id) - 1) ELSE location_id END) AS city_code,
      CASE WHEN m IS NOT NULL THEN CASE WHEN location_id = m THEN 'centro' ELSE substring(location_id, length(m) + 2) END
           WHEN position('_' IN location_id) > 0 THEN substring(location_id, position('_' IN location_id) + 1)
           ELSE 'centro' END AS neighborhood_code
    FROM matched)
  SELECT row_number() OVER (ORDER BY location_id) AS location_key, location_id,
         {_LCITY} AS city_name, city_code, {_LNB} AS neighborhood_name, neighborhood_code,
         CASE WHEN city_code IN ({_LRS}) THEN 'RS' ELSE 'SC' END AS state_code, 'BR' AS country_code,
         NULL::DECIMAL(9,6) AS latitude, NULL::DECIMAL(9,6) AS longitude
  FROM parsed
)""", ["tru"])

register("dim_store_location", """
dim_store_location AS (
  SELECT row_number() OVER (ORDER BY s.store_key, l.location_key) AS store_location_key,
         s.store_key, l.location_key, p.store_id, p.region_code AS location_id, l.city_name,
         l.neighborhood_name, NULL::VARCHAR AS store_address, rs.hub_id, rs.sc_code, true AS is_active,
         NULL::DATE AS opened_at, NULL::DATE AS closed_at
  FROM (SELECT DISTINCT supermarket AS store_id, region AS region_code FROM tru
        WHERE supermarket IS NOT NULL AND region IS NOT NULL) p
  JOIN dim_store s ON p.store_id = s.store_id
  JOIN dim_location l ON p.region_code = l.location_id
  LEFT JOIN region_seed rs ON rs.store = p.store_id AND rs.region_code = p.region_code
)""", ["tru", "dim_store", "dim_location", "region_seed"])

register("dim_ean", """
dim_ean AS (
  WITH v AS (SELECT DISTINCT unnest(eans) AS ean_code FROM tru WHERE eans IS NOT NULL AND len(eans) > 0),
  o AS (SELECT * FROM stg_ref QUALIFY row_number() OVER (PARTITION BY ean_code ORDER BY scraped_at DESC, run_id DESC) = 1)
  SELECT row_number() OVER (ORDER BY v.ean_code) AS ean_key, v.ean_code,
         coalesce(o.product_name, 'Unknown') AS canonical_name, coalesce(o.brands, 'Unknown') AS canonical_brand,
         o.categories, o.quantity AS net_weight, o.countries AS country_of_origin, o.nutriscore_grade,
         CASE WHEN o.nutriscore_grade IN ('a', 'b') THEN 'Excellent' WHEN o.nutriscore_grade = 'c' THEN 'Good'
              WHEN o.nutriscore_grade = 'd' THEN 'Fair' WHEN o.nutriscore_grade = 'e' THEN 'Poor'
              ELSE 'Unknown' END AS nutrition_quality,
         o.ean_code IS NOT NULL AS is_enriched
  FROM v LEFT JOIN o ON v.ean_code = o.ean_code
)""", ["tru", "stg_ref"])


# ----------------------------------------------------------------------- facts
def S(x: str) -> str:
    """Snap a double to 6 decimals (same as functions.columns.snap)."""
    return f"CAST(CAST({x} AS DECIMAL(38,6)) AS DOUBLE)"


def MAVG(x: str) -> str:
    """Average of 2-decimal values from an exact integer sum (same as money_avg)."""
    return f"CAST(sum(CAST(round({x} * 10000) AS BIGINT)) AS DOUBLE) / CAST(count({x}) AS DOUBLE) / 10000.0"


def MSUM(x: str) -> str:
    return f"CAST(sum(CAST(round({x} * 10000) AS BIGINT)) AS DOUBLE) / 10000.0"


def R(x: str, n: int = 2) -> str:
    """round() decided on the decimal value (same as functions.columns.round_half_up)."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), {n}) AS DOUBLE)"


def PCT(num: str, den: str) -> str:
    return R(f"(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)) * 100")


register("fct_daily_prices", f"""
fct_daily_prices AS (
  SELECT p.scraped_date, dp.product_key, ds.store_key, dr.region_key, dd.date_key, db.brand_key, de.ean_key,
         p.product_id, p.product_name, p.supermarket, p.region, p.brand,
         p.min_price, p.max_price, p.avg_price, p.min_list_price,
         p.max_price - p.min_price AS price_range,
         CASE WHEN p.min_list_price > 0 AND p.min_price > 0
              THEN {R("((p.min_list_price - p.min_price) / p.min_list_price) * 100")} ELSE 0 END AS discount_pct,
         p.sku_count, p.is_available, p.total_available_quantity, p.run_id, p.scraped_at
  FROM tru p
  JOIN dim_product dp ON p.product_id = dp.product_id
  JOIN dim_store ds ON p.supermarket = ds.store_id
  JOIN dim_region dr ON p.region = dr.region_code
  JOIN dim_date dd ON p.scraped_date = dd.date_day
  LEFT JOIN dim_brand db ON p.brand = db.brand_name
  LEFT JOIN dim_ean de ON de.ean_code = p.eans[1]
)""", ["tru", "dim_product", "dim_store", "dim_region", "dim_date", "dim_brand", "dim_ean"])

register("fct_active_promotions", f"""
fct_active_promotions AS (
  SELECT product_key, product_id, product_name, brand_key, brand, store_key, supermarket, region_key, region,
         date_key, scraped_date, min_price AS promotional_price, min_list_price AS regular_price,
         discount_pct AS discount_percentage, avg_price,
         min_list_price - min_price AS absolute_discount,
         {R("discount_pct", 0)} AS discount_tier,
         CASE WHEN discount_pct >= 50 THEN 'Hot Deal (50%+)' WHEN discount_pct >= 30 THEN 'Strong Discount (30-50%)'
              WHEN discount_pct >= 15 THEN 'Moderate Discount (15-30%)' WHEN discount_pct >= 5 THEN 'Light Discount (5-15%)'
              ELSE 'Minimal Discount (<5%)' END AS promotion_type,
         discount_pct >= 30 AS is_hot_deal,
         is_available
  FROM fct_daily_prices
  WHERE discount_pct > 0 AND min_list_price > 0 AND min_price > 0
)""", ["fct_daily_prices"])

register("fct_hot_deals_validated", """
fct_hot_deals_validated AS (
  WITH raw AS (
    SELECT * FROM fct_active_promotions
    WHERE discount_percentage >= 20 AND is_hot_deal AND regular_price > promotional_price),
  flags AS (
    SELECT *, discount_percentage > 70 AS is_suspicious_discount,
           promotional_price <= 0 OR regular_price <= 0 AS has_invalid_price,
           discount_percentage >= 20 AND discount_percentage <= 50 AS is_optimal_discount_range,
           coalesce(brand IS NOT NULL AND length(brand) > 2, false) AS has_known_brand
    FROM raw),
  scored AS (
    SELECT *,
      CAST((CASE WHEN is_optimal_discount_range THEN 50 ELSE 0 END) + (CASE WHEN NOT is_suspicious_discount THEN 30 ELSE 0 END)
         + (CASE WHEN NOT has_invalid_price THEN 10 ELSE 0 END) + (CASE WHEN has_known_brand THEN 10 ELSE 0 END) AS INTEGER) AS quality_score,
      CASE WHEN is_suspicious_discount OR has_invalid_price THEN 'Suspicious'
           WHEN is_optimal_discount_range AND has_known_brand THEN 'High Quality'
           WHEN is_optimal_discount_range THEN 'Good Quality' ELSE 'Review Required' END AS legitimacy_level
    FROM flags),
  persisted AS (
    SELECT *,
      count(*) OVER (PARTITION BY product_key, store_key ORDER BY scraped_date, region_key
                     ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS deal_persistence_days,
      count(DISTINCT scraped_date) OVER (PARTITION BY product_key, store_key ORDER BY scraped_date
                     RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS persistence_days
    FROM scored),
  ranked AS (
    SELECT *, deal_persistence_days = 1 AS is_flash_deal,
      row_number() OVER (PARTITION BY store_key, date_key ORDER BY quality_score DESC, discount_percentage DESC, product_key, region_key) AS quality_rank,
      row_number() OVER (PARTITION BY store_key, date_key ORDER BY absolute_discount DESC, product_key, region_key) AS savings_rank,
      row_number() OVER (PARTITION BY store_key, date_key ORDER BY
          CASE legitimacy_level WHEN 'High Quality' THEN 1 WHEN 'Good Quality' THEN 2 WHEN 'Review Required' THEN 3 ELSE 4 END,
          discount_percentage DESC, product_key, region_key) AS overall_rank
    FROM persisted)
  SELECT product_key, product_id, product_name, brand_key, brand, store_key, supermarket, region_key, region,
         date_key, scraped_date, promotional_price, regular_price, discount_percentage, absolute_discount,
         quality_score, legitimacy_level, is_suspicious_discount, has_invalid_price, is_optimal_discount_range,
         has_known_brand, deal_persistence_days, persistence_days, is_flash_deal, quality_rank, savings_rank,
         overall_rank, is_available,
         legitimacy_level IN ('High Quality', 'Good Quality') AND NOT is_suspicious_discount AND NOT is_flash_deal
           AND quality_score >= 70 AS is_recommended_deal
  FROM ranked
)""", ["fct_active_promotions"])

register("vw_suspicious_hot_deals", f"""
vw_suspicious_hot_deals AS (
  SELECT product_id, product_name, brand, supermarket, region, scraped_date, promotional_price, regular_price,
         discount_percentage, absolute_discount, quality_score, legitimacy_level, deal_persistence_days, is_available,
         concat_ws(', ',
           CASE WHEN is_suspicious_discount THEN '{config.FLAG_EXTREME}' END,
           CASE WHEN has_invalid_price THEN '{config.FLAG_INVALID}' END,
           CASE WHEN is_flash_deal THEN '{config.FLAG_FLASH}' END,
           CASE WHEN quality_score < 50 THEN '{config.FLAG_LOW_QUALITY}' END) AS suspicious_reasons,
         CAST((CASE WHEN is_suspicious_discount THEN 5 ELSE 0 END) + (CASE WHEN has_invalid_price THEN 4 ELSE 0 END)
           + (CASE WHEN is_flash_deal AND discount_percentage > 50 THEN 3 ELSE 0 END)
           + (CASE WHEN quality_score < 30 THEN 2 ELSE 0 END) AS INTEGER) AS suspicion_severity,
         CASE WHEN is_suspicious_discount AND is_flash_deal THEN 'CRITICAL'
              WHEN is_suspicious_discount OR has_invalid_price THEN 'HIGH'
              WHEN is_flash_deal AND discount_percentage > 50 THEN 'MEDIUM' ELSE 'LOW' END AS review_priority,
         is_suspicious_discount, has_invalid_price, is_flash_deal
  FROM fct_hot_deals_validated
  WHERE legitimacy_level = 'Suspicious' OR is_suspicious_discount OR has_invalid_price
     OR (is_flash_deal AND discount_percentage > 50) OR quality_score < 30
)""", ["fct_hot_deals_validated"])

register("fct_promotion_summary", f"""
fct_promotion_summary AS (
  WITH pa AS (
    SELECT store_key, supermarket, region_key, region, date_key, scraped_date,
           count(DISTINCT product_key) AS products_on_promotion,
           count(DISTINCT CASE WHEN is_hot_deal THEN product_key END) AS hot_deal_products,
           count(DISTINCT brand_key) AS brands_on_promotion,
           {MAVG("discount_percentage")} AS avg_discount_pct,
           min(discount_percentage) AS min_discount_pct, max(discount_percentage) AS max_discount_pct,
           {S("median(discount_percentage)")} AS median_discount_pct,
           {MSUM("absolute_discount")} AS total_potential_savings,
           {MAVG("absolute_discount")} AS avg_absolute_discount,
           {MAVG("promotional_price")} AS avg_promotional_price,
           {MAVG("regular_price")} AS avg_regular_price
    FROM fct_active_promotions
    GROUP BY store_key, supermarket, region_key, region, date_key, scraped_date),
  dp AS (
    SELECT store_key, region_key, date_key, count(DISTINCT product_key) AS total_products
    FROM fct_daily_prices GROUP BY store_key, region_key, date_key)
  SELECT pa.*, dp.total_products, {PCT("pa.products_on_promotion", "dp.total_products")} AS promotion_penetration_pct
  FROM pa LEFT JOIN dp ON pa.store_key = dp.store_key AND pa.region_key = dp.region_key AND pa.date_key = dp.date_key
)""", ["fct_active_promotions", "fct_daily_prices"])

register("fct_daily_price_index", f"""
fct_daily_price_index AS (
  SELECT supermarket, region, scraped_date,
         count(DISTINCT product_id) AS total_products,
         count(DISTINCT CASE WHEN is_available THEN product_id END) AS available_products,
         count(DISTINCT CASE WHEN NOT is_available THEN product_id END) AS unavailable_products,
         min(min_price) AS min_product_price, max(min_price) AS max_product_price,
         {MAVG("min_price")} AS avg_product_price,
         {S("median(min_price)")} AS median_product_price,
         {S("stddev_samp(min_price)")} AS stddev_product_price,
         {S("quantile_cont(min_price, 0.25)")} AS p25_product_price,
         {S("quantile_cont(min_price, 0.75)")} AS p75_product_price,
         {S("quantile_cont(min_price, 0.90)")} AS p90_product_price,
         {S("quantile_cont(min_price, 0.95)")} AS p95_product_price,
         CAST(sum(total_available_quantity) AS BIGINT) AS total_inventory_units,
         {PCT("count(DISTINCT CASE WHEN is_available THEN product_id END)", "count(DISTINCT product_id)")} AS availability_rate_pct
  FROM tru WHERE min_price IS NOT NULL
  GROUP BY supermarket, region, scraped_date
)""", ["tru"])

_CMP = f"""min_price - lowest_price AS price_diff_vs_lowest,
         {PCT("min_price - lowest_price", "lowest_price")} AS price_premium_pct,
         highest_price - lowest_price AS price_spread,
         {PCT("highest_price - lowest_price", "lowest_price")} AS price_spread_pct,
         price_rank = 1 AS is_cheapest, min_price = highest_price AS is_most_expensive"""

register("fct_price_comparison", f"""
fct_price_comparison AS (
  WITH dp AS (
    SELECT product_id, product_name, brand, scraped_date, supermarket, region, min_price, avg_price, is_available
    FROM tru WHERE min_price IS NOT NULL),
  m AS (SELECT product_id, scraped_date FROM dp GROUP BY product_id, scraped_date HAVING count(DISTINCT supermarket) >= 2),
  pc AS (
    SELECT p.*, min(p.min_price) OVER w AS lowest_price, max(p.min_price) OVER w AS highest_price,
           CAST(sum(CAST(round(p.min_price * 10000) AS BIGINT)) OVER w AS DOUBLE) / CAST(count(p.min_price) OVER w AS DOUBLE) / 10000.0 AS market_avg_price,
           row_number() OVER (PARTITION BY p.product_id, p.scraped_date ORDER BY p.min_price, p.supermarket, p.region) AS price_rank
    FROM dp p JOIN m ON p.product_id = m.product_id AND p.scraped_date = m.scraped_date
    WINDOW w AS (PARTITION BY p.product_id, p.scraped_date))
  SELECT *, {_CMP} FROM pc
)""", ["tru"])

register("fct_price_comparison_v2", f"""
fct_price_comparison_v2 AS (
  WITH dp AS (
    SELECT product_key, product_id, product_name, brand_key, brand, date_key, scraped_date, store_key, supermarket,
           region_key, region, min_price, avg_price, is_available,
           lower(trim(regexp_replace(product_name, '\\s+', ' ', 'g'))) AS product_name_normalized
    FROM fct_daily_prices WHERE min_price IS NOT NULL),
  m AS (SELECT product_name_normalized, date_key FROM dp GROUP BY ALL HAVING count(DISTINCT store_key) >= 2),
  pc AS (
    SELECT p.*, min(p.min_price) OVER w AS lowest_price, max(p.min_price) OVER w AS highest_price,
           CAST(sum(CAST(round(p.min_price * 10000) AS BIGINT)) OVER w AS DOUBLE) / CAST(count(p.min_price) OVER w AS DOUBLE) / 10000.0 AS market_avg_price,
           row_number() OVER (PARTITION BY p.product_name_normalized, p.date_key
                              ORDER BY p.min_price, p.store_key, p.region_key, p.product_key) AS price_rank
    FROM dp p JOIN m ON p.product_name_normalized = m.product_name_normalized AND p.date_key = m.date_key
    WINDOW w AS (PARTITION BY p.product_name_normalized, p.date_key))
  SELECT *, {_CMP} FROM pc
)""", ["fct_daily_prices"])

register("fct_product_availability", """
fct_product_availability AS (
  SELECT product_id, product_name, brand, supermarket, region, scraped_date, is_available, total_available_quantity,
         sku_count, min_price,
         CASE WHEN NOT is_available THEN 'out_of_stock' WHEN total_available_quantity = 0 THEN 'out_of_stock'
              WHEN total_available_quantity <= 5 THEN 'low_stock' WHEN total_available_quantity <= 20 THEN 'medium_stock'
              ELSE 'in_stock' END AS stock_status,
         coalesce(total_available_quantity > 0 AND total_available_quantity <= 5, false) AS is_low_inventory
  FROM tru
)""", ["tru"])
