"""Registered queries: data-quality suites (DQ-*) and validation rule counts (VAL-*)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import config
from ..functions import validate as V
from ..operators import quality as Q
from ..plans.trusted import CONTRACT, NOT_NULL
from ..plans.warehouse import warehouse
from ..sources import adapter
from . import q_reports  # noqa: F401  (registers the silver_products CTE)
from .oracle import register as cte, with_ctes
from .registry import register

AS_OF = config.DEFAULT_AS_OF


def _wh(spark, sf):
    return warehouse(spark, sf)


def _sum_sql(test, model, column, failing_count_sql, severity="error", warn_if=0, error_if=0):
    col = "NULL" if column is None else f"'{column}'"
    return (f"SELECT '{test}' AS test, '{model}' AS model, CAST({col} AS VARCHAR) AS column_name, "
            f"'{severity}' AS severity, n AS failures, "
            f"CASE WHEN '{severity}' = 'error' AND n > {error_if} THEN 'fail' WHEN n > {warn_if} THEN 'warn' "
            f"ELSE 'pass' END AS status FROM ({failing_count_sql}) AS c(n)")


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------------ DQ-01
@register("DQ-01", with_ctes(["tru"], _union([
    _sum_sql("not_null", "tru_product", c, f"SELECT count(*) FROM tru WHERE {c} IS NULL") for c in NOT_NULL])))
def dq01(spark, sf):
    t = _wh(spark, sf).tru()
    return Q.suite([Q.summarize(Q.not_null(t, c), "not_null", "tru_product", c) for c in NOT_NULL])


# ------------------------------------------------------------------ DQ-02 / DQ-03
UNIQUE = [("dim_product", "product_key"), ("dim_product", "product_id"), ("dim_brand", "brand_key"),
          ("dim_brand", "brand_name"), ("dim_region", "region_key"), ("dim_region", "region_code"),
          ("dim_location", "location_key"), ("dim_ean", "ean_key"), ("dim_ean", "ean_code"),
          ("dim_date", "date_key")]


def _dup_sql(model, cols):
    k = ", ".join(cols)
    nn = " OR ".join(f"{c} IS NOT NULL" for c in cols)
    return f"SELECT count(*) FROM (SELECT {k} FROM {model} WHERE {nn} GROUP BY {k} HAVING count(*) > 1)"


@register("DQ-02", with_ctes(sorted({m for m, _ in UNIQUE}), _union([
    _sum_sql("unique", m, c, _dup_sql(m, [c])) for m, c in UNIQUE])))
def dq02(spark, sf):
    w = _wh(spark, sf)
    return Q.suite([Q.summarize(Q.unique(w.dim(m), [c]), "unique", m, c) for m, c in UNIQUE])


COMBOS = [("tru", "tru_product", ["product_id", "supermarket", "region", "scraped_date"]),
          ("dim_store_location", "dim_store_location", ["store_key", "location_key"]),
          ("fct_daily_prices", "fct_daily_prices", ["product_key", "store_key", "region_key", "date_key"])]


@register("DQ-03", with_ctes([c for c, _, _ in COMBOS], _union([
    _sum_sql("unique_combination_of_columns", m, "|".join(cols), _dup_sql(c, cols)) for c, m, cols in COMBOS])))
def dq03(spark, sf):
    w = _wh(spark, sf)
    frames = {"tru_product": w.tru(), "dim_store_location": w.dim("dim_store_location"),
              "fct_daily_prices": w.fact("fct_daily_prices")}
    return Q.suite([Q.summarize(Q.unique(frames[m], cols), "unique_combination_of_columns", m, "|".join(cols))
                    for _, m, cols in COMBOS])


# ------------------------------------------------------------------ DQ-04
ACCEPTED = [
    ("fct_active_promotions", "promotion_type",
     [label for _, label in config.PROMOTION_TYPES] + [config.PROMOTION_TYPE_OTHER]),
    ("fct_hot_deals_validated", "legitimacy_level", ["High Quality", "Good Quality", "Review Required", "Suspicious"]),
    ("fct_product_availability", "stock_status", ["out_of_stock", "low_stock", "medium_stock", "in_stock"]),
    ("dim_brand", "brand_tier", ["Major Brand", "Medium Brand", "Small Brand"]),
]


def _frame(w, m):
    return w.dim(m) if m.startswith("dim_") else w.fact(m)


@register("DQ-04", with_ctes([m for m, _, _ in ACCEPTED], _union([
    _sum_sql("accepted_values", m, c,
             f"SELECT count(*) FROM {m} WHERE {c} IS NOT NULL AND {c} NOT IN ({', '.join(repr(v) for v in vals)})")
    for m, c, vals in ACCEPTED])))
def dq04(spark, sf):
    w = _wh(spark, sf)
    return Q.suite([Q.summarize(Q.accepted_values(_frame(w, m), c, vals), "accepted_values", m, c)
                    for m, c, vals in ACCEPTED])


# ------------------------------------------------------------------ DQ-05
FKS = [("product_key", "dim_product"), ("store_key", "dim_store"), ("region_key", "dim_region"),
       ("date_key", "dim_date"), ("brand_key", "dim_brand"), ("ean_key", "dim_ean")]


@register("DQ-05", with_ctes(["fct_daily_prices"] + [p for _, p in FKS], _union([
    _sum_sql("relationships", "fct_daily_prices", c,
             f"SELECT count(*) FROM fct_daily_prices f WHERE f.{c} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {p} d WHERE d.{c} = f.{c})") for c, p in FKS])))
def dq05(spark, sf):
    w = _wh(spark, sf)
    f = w.fact("fct_daily_prices")
    return Q.suite([Q.summarize(Q.relationships(f, c, w.dim(p), c), "relationships", "fct_daily_prices", c)
                    for c, p in FKS])


# ------------------------------------------------------------------ DQ-06
RANGES = [("fct_daily_prices", "min_price", 0, 100000), ("fct_daily_prices", "discount_pct", 0, 100),
          ("fct_hot_deals_validated", "quality_score", 0, 100),
          ("fct_hot_deals_validated", "discount_percentage", 20, 100)]


@register("DQ-06", with_ctes(sorted({m for m, *_ in RANGES}) + ["tru"], _union([
    _sum_sql("accepted_range", m, c, f"SELECT count(*) FROM {m} WHERE {c} IS NOT NULL AND ({c} < {lo} OR {c} > {hi})")
    for m, c, lo, hi in RANGES] + [
    _sum_sql("accepted_range", "fct_price_comparison", "store_rank",
             "SELECT count(*) FROM (SELECT dense_rank() OVER (PARTITION BY product_id, scraped_date ORDER BY "
             "min_price) AS r FROM (SELECT product_id, scraped_date, supermarket, min(min_price) AS min_price "
             "FROM tru WHERE min_price IS NOT NULL GROUP BY ALL)) WHERE r < 1 OR r > 10")])))
def dq06(spark, sf):
    from pyspark.sql import Window
    w = _wh(spark, sf)
    parts = [Q.summarize(Q.accepted_range(_frame(w, m), c, lo, hi), "accepted_range", m, c)
             for m, c, lo, hi in RANGES]
    # decision: the rank range test applies to the store-level rank (one price per store)
    st = (w.tru().where(F.col("min_price").isNotNull())
          .groupBy("product_id", "scraped_date", "supermarket").agg(F.min("min_price").alias("min_price")))
    st = st.withColumn("store_rank", F.dense_rank().over(
        Window.partitionBy("product_id", "scraped_date").orderBy("min_price")))
    parts.append(Q.summarize(Q.accepted_range(st, "store_rank", 1, 10), "accepted_range", "fct_price_comparison",
                             "store_rank"))
    return Q.suite(parts)


# ------------------------------------------------------------------ DQ-07
EXPRS = [("regular_price > promotional_price", "error", 0, 0),
         ("quality_score BETWEEN 0 AND 100", "error", 0, 0),
         ("discount_percentage <= 70", "warn", 0, 0),
         ("deal_persistence_days BETWEEN 1 AND 7", "error", 0, 10)]


@register("DQ-07", with_ctes(["fct_hot_deals_validated"], _union([
    _sum_sql("expression_is_true", "fct_hot_deals_validated", e,
             f"SELECT count(*) FROM fct_hot_deals_validated WHERE NOT coalesce({e}, false)", sev, wi, ei)
    for e, sev, wi, ei in EXPRS])))
def dq07(spark, sf):
    h = _wh(spark, sf).fact("fct_hot_deals_validated")
    return Q.suite([Q.summarize(Q.expression_is_true(h, e), "expression_is_true", "fct_hot_deals_validated", e,
                                sev, wi, ei) for e, sev, wi, ei in EXPRS])


# ------------------------------------------------------------------ DQ-08
@register("DQ-08", with_ctes(["fct_hot_deals_validated", "fct_active_promotions"], _sum_sql(
    "fewer_rows_than", "fct_hot_deals_validated", "store_key",
    "SELECT count(*) FROM (SELECT store_key, count(*) AS a FROM fct_hot_deals_validated WHERE is_recommended_deal "
    "GROUP BY store_key) h FULL JOIN (SELECT store_key, count(*) AS b FROM fct_active_promotions GROUP BY store_key) p "
    "USING (store_key) WHERE coalesce(a, 0) >= coalesce(b, 0)")))
def dq08(spark, sf):
    w = _wh(spark, sf)
    f = Q.fewer_rows_than(w.fact("fct_hot_deals_validated"), w.fact("fct_active_promotions"), ["store_key"],
                          where="is_recommended_deal")
    return Q.summarize(f, "fewer_rows_than", "fct_hot_deals_validated", "store_key")


# ------------------------------------------------------------------ DQ-09
FRESH_AT = dt.datetime.combine(AS_OF, dt.time(23, 59, 59))


@register("DQ-09", with_ctes(["tru"], _union([
    _sum_sql("recency", "tru_product", "scraped_at",
             f"SELECT count(*) FROM (SELECT max(scraped_at) AS m FROM tru) WHERE m IS NULL OR "
             f"m < TIMESTAMP '{(FRESH_AT - dt.timedelta(days=1)).isoformat(sep=' ')}'", "warn"),
    _sum_sql("recency", "tru_product", "scraped_at",
             f"SELECT count(*) FROM (SELECT max(scraped_at) AS m FROM tru) WHERE m IS NULL OR "
             f"m < TIMESTAMP '{(FRESH_AT - dt.timedelta(hours=12)).isoformat(sep=' ')}'", "error")])))
def dq09(spark, sf):
    t = _wh(spark, sf).tru()
    return Q.suite([
        Q.summarize(Q.recency(t, "scraped_at", FRESH_AT, dt.timedelta(days=1)), "recency", "tru_product",
                    "scraped_at", "warn"),
        Q.summarize(Q.recency(t, "scraped_at", FRESH_AT, dt.timedelta(hours=12)), "recency", "tru_product",
                    "scraped_at", "error")])


# ------------------------------------------------------------------ DQ-10
_DUCK = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "boolean": "BOOLEAN", "date": "DATE",
         "timestamp": "TIMESTAMP", "array<string>": "VARCHAR[]"}


def _contract_sql(f):
    kind = f.dataType.simpleString()
    ok = f"typeof(any_value({f.name})) IN ('{_DUCK[kind]}', '\"NULL\"')"
    return (f"SELECT '{f.name}' AS column_name, '{kind}' AS expected, CASE WHEN {ok} THEN '{kind}' END AS actual, "
            f"count(*) AS checked, count(*) - count({f.name}) AS nulls, "
            f"{ok} AND {'true' if f.nullable else f'count(*) = count({f.name})'} AS holds FROM tru")


@register("DQ-10", with_ctes(["tru"], _union([_contract_sql(f) for f in CONTRACT.fields])))
def dq10(spark, sf):
    """The trusted table's files against the contract: types as written, nulls as counted."""
    return Q.schema_contract(_wh(spark, sf).tru(), CONTRACT)


# ------------------------------------------------------------------ DQ-11
NONNEG = [("fct_daily_prices", "min_price"), ("fct_daily_prices", "sku_count"),
          ("fct_daily_prices", "total_available_quantity"), ("fct_active_promotions", "absolute_discount")]


@register("DQ-11", with_ctes(["fct_daily_prices", "fct_active_promotions"], _union([
    _sum_sql("non_negative", m, c, f"SELECT count(*) FROM {m} WHERE {c} < 0", "warn") for m, c in NONNEG])))
def dq11(spark, sf):
    w = _wh(spark, sf)
    return Q.suite([Q.summarize(Q.non_negative(w.fact(m), c), "non_negative", m, c, "warn") for m, c in NONNEG])


# ------------------------------------------------------------------ DQ-12
@register("DQ-12", with_ctes(["fct_daily_prices", "tru"], _union([
    _sum_sql("reconcile_rows", "fct_daily_prices", None,
             "SELECT count(*) FROM (SELECT (SELECT count(*) FROM fct_daily_prices) AS a, (SELECT count(*) FROM tru) AS b) "
             "WHERE a <> b"),
    _sum_sql("reconcile_price_cents", "fct_daily_prices", "min_price",
             "SELECT count(*) FROM (SELECT (SELECT sum(CAST(round(min_price * 10000) AS BIGINT)) FROM fct_daily_prices) AS a, "
             "(SELECT sum(CAST(round(min_price * 10000) AS BIGINT)) FROM tru) AS b) WHERE a <> b")])))
def dq12(spark, sf):
    from ..functions.columns import money_units
    w = _wh(spark, sf)
    f, t = w.fact("fct_daily_prices"), w.tru()
    return Q.suite([
        Q.summarize(Q.reconcile(f, t, F.count(F.lit(1)), F.count(F.lit(1))), "reconcile_rows", "fct_daily_prices"),
        Q.summarize(Q.reconcile(f, t, F.sum(money_units("min_price")), F.sum(money_units("min_price"))),
                    "reconcile_price_cents", "fct_daily_prices", "min_price")])


# ------------------------------------------------------------------ DQ-13
@register("DQ-13", with_ctes(["silver_products"], _union([
    _sum_sql("duplicate_ids", "silver_products", "sku",
             "SELECT count(*) FROM silver_products s WHERE (sku, supermarket, region, collected_at) IN "
             "(SELECT (sku, supermarket, region, collected_at) FROM silver_products GROUP BY ALL HAVING count(*) > 1)",
             "warn"),
    _sum_sql("price_range", "silver_products", "price",
             "SELECT count(*) FROM silver_products WHERE price < 0 OR price > 100000", "warn")])))
def dq13(spark, sf):
    s = _wh(spark, sf).silver().withColumn(
        "_id", F.concat_ws("|", "sku", "supermarket", "region", F.col("collected_at").cast("string")))
    return Q.suite([
        Q.summarize(Q.duplicate_ids(s, "_id"), "duplicate_ids", "silver_products", "sku", "warn"),
        Q.summarize(Q.accepted_range(s, "price", 0, 100000), "price_range", "silver_products", "price", "warn")])


# ------------------------------------------------------------------ DQ-14
RECENT = (AS_OF - dt.timedelta(days=7)).isoformat()


@register("DQ-14", with_ctes(["fct_daily_prices"], _union([
    _sum_sql("accepted_range", "fct_daily_prices", "min_price",
             f"SELECT count(*) FROM fct_daily_prices WHERE scraped_date >= DATE '{RECENT}' AND min_price IS NOT NULL "
             f"AND (min_price < 0 OR min_price > 100000)"),
    _sum_sql("not_null", "fct_daily_prices", "brand_key",
             f"SELECT count(*) FROM fct_daily_prices WHERE scraped_date >= DATE '{RECENT}' AND brand_key IS NULL",
             "warn")])))
def dq14(spark, sf):
    f = _wh(spark, sf).fact("fct_daily_prices").where(F.col("scraped_date") >= F.lit(dt.date.fromisoformat(RECENT)))
    return Q.suite([Q.summarize(Q.accepted_range(f, "min_price", 0, 100000), "accepted_range", "fct_daily_prices",
                                "min_price"),
                    Q.summarize(Q.not_null(f, "brand_key"), "not_null", "fct_daily_prices", "brand_key", "warn")])


# ------------------------------------------------------------------ VAL
def _rules_sql(rules: dict[str, str], source: str) -> str:
    parts = [f"SELECT '{n}' AS rule, count(*) AS checked, count(*) FILTER (WHERE NOT coalesce({e}, false)) AS failures "
             f"FROM {source}" for n, e in rules.items()]
    return _union(parts)


PACK = "line_number % 2 <> 0"
SQL_PRODUCT_RULES = {
    "VAL-06 productId": "trim(coalesce(product_id, '')) <> ''",
    "VAL-06 productName": "trim(coalesce(product_name, '')) <> '' AND length(trim(product_name)) <= 500",
    "VAL-06 link": "trim(coalesce(product_url, '')) <> ''",
    "VAL-06 items": "true",
    "VAL-04 item": "trim(coalesce(item_id, '')) <> ''",
    "VAL-03 seller": "trim(coalesce(seller_id, '')) <> ''",
    "VAL-01 offer": (f"price > 0 AND available_quantity >= 0 AND list_price >= price AND "
                     f"({PACK} OR (price * 2 > 0 AND floor(available_quantity / 2) >= 0 AND list_price * 2 >= price * 2))"),
}


def _product_rule_counts(spark, sf, prefix):
    b = _wh(spark, sf).bronze()
    rules = {n: r for n, r in V.product_rules(b).items() if n.startswith(prefix)}
    return V.rule_counts(b, rules)


for _vid in ("VAL-01", "VAL-03", "VAL-04", "VAL-06"):
    register(_vid, with_ctes(["obs"], _rules_sql(
        {n: e for n, e in SQL_PRODUCT_RULES.items() if n.startswith(_vid)}, "obs")))(
        (lambda p: (lambda spark, sf: _product_rule_counts(spark, sf, p)))(_vid))


# the full payload: order key o, line l, suppliers as sellers; prices in whole cents
cte("payload", """
payload AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS record_id, l_orderkey AS o, l_linenumber AS l,
         CAST(l_suppkey AS VARCHAR) AS seller_id, i AS items_pos,
         (CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)) / 100.0 AS price,
         round(l_discount * 100, 0) AS pct, l_discount
  FROM lineitem, range(1, 3) r(i) WHERE i = 1 OR l_linenumber % 2 = 0
)""", [])

_REJECTS = """
SELECT record_id, CAST(items_pos AS INTEGER) AS items_pos, 1 AS sellers_pos, seller_id AS "sellerId", rule FROM (
  SELECT *, 'Price' AS rule FROM payload WHERE price <= 0
  UNION ALL SELECT *, 'PriceWithoutDiscount' FROM payload WHERE o % 13 = 0
  UNION ALL SELECT *, 'RewardValue' FROM payload WHERE o % 19 = 0
  UNION ALL SELECT *, 'Tax' FROM payload WHERE o % 17 = 0)"""


@register("VAL-01b", with_ctes(["payload"], _REJECTS))
def val01b(spark, sf):
    """Offers of the full payload: the places that break a price, reward or tax rule."""
    return V.offer_rejects(adapter.full_offers(spark, sf), ["record_id"])


@register("VAL-02", with_ctes(["payload"], """
SELECT record_id, CAST(items_pos AS INTEGER) AS items_pos, 1 AS sellers_pos, CAST(p AS INTEGER) AS "Promotions_pos",
       'P' || p || '-' || o AS "promotionId", rule FROM (
  SELECT *, 1 AS p, 'discountValue' AS rule FROM payload WHERE o % 29 = 0 AND l % 3 >= 1
  UNION ALL SELECT *, 2, 'discountPercentage' FROM payload WHERE o % 23 = 0 AND l % 3 >= 2)"""))
def val02(spark, sf):
    """Promotions, nested three deep: the places that break a rule."""
    return V.promotion_rejects(adapter.full_offers(spark, sf), ["record_id"])


@register("VAL-05", with_ctes(["payload"], """
SELECT record_id, CAST(items_pos AS INTEGER) AS items_pos, 2 AS images_pos,
       record_id || '-' || items_pos || '-b' AS "imageId", 'imageUrl' AS rule
FROM payload WHERE o % 31 = 0 AND items_pos = 2"""))
def val05(spark, sf):
    """Images without an address."""
    return V.image_rejects(adapter.full_offers(spark, sf), ["record_id"])


@register("VAL-05b", with_ctes(["payload"], """
SELECT count(*) AS items, sum(CASE WHEN l % 2 = 0 THEN 0 ELSE 2 END)::BIGINT AS https_before, (count(*) * 2)::BIGINT AS https_after
FROM payload WHERE record_id NOT IN (SELECT record_id FROM payload WHERE o % 31 = 0 AND items_pos = 2)"""))
def val05b(spark, sf):
    """Images of the records whose images are all in order, with http turned into https."""
    df = adapter.full_offers(spark, sf)
    good = df.where(F.forall("items", lambda i: V.image_rules(i["images"])))
    https = lambda images: F.size(F.filter(images, lambda im: im["imageUrl"].startswith("https:")))
    i = good.select(F.explode("items").alias("i"))
    return i.agg(F.count(F.lit(1)).alias("items"), F.sum(https(F.col("i.images"))).alias("https_before"),
                 F.sum(https(V.normalize_images(F.col("i.images")))).alias("https_after"))


@register("VAL-07", """
WITH w AS (
  SELECT *, string_split(p_name, ' ')[1] AS first, string_split(p_name, ' ')[2] AS second,
         CASE WHEN p_partkey % 11 = 0 THEN '  ' ELSE 'size ' || p_size END AS size FROM part),
node AS (
  SELECT p_partkey AS doc_id, 1 AS depth, p_type AS path, p_partkey * 10 + 1 AS id, p_type AS name FROM w
  UNION ALL SELECT p_partkey, 2, p_type || ' > ' || p_brand, p_partkey * 10 + 2, p_brand FROM w
  UNION ALL SELECT p_partkey, 2, p_type || ' > Other', p_partkey * 10 + 6, 'Other' FROM w
  UNION ALL SELECT p_partkey, 3, p_type || ' > ' || p_brand || ' > ' || second, p_partkey * 10 + 3, second FROM w
  UNION ALL SELECT p_partkey, 4, p_type || ' > ' || p_brand || ' > ' || second || ' > ' || first,
                   CASE WHEN p_partkey % 7 = 0 THEN -p_partkey ELSE p_partkey * 10 + 4 END, first FROM w WHERE p_partkey % 5 <> 0
  UNION ALL SELECT p_partkey, 4, p_type || ' > ' || p_brand || ' > ' || second || ' > ' || size, p_partkey * 10 + 5, size
            FROM w WHERE p_partkey % 5 <> 0)
SELECT doc_id, depth, path, id, concat_ws(', ', CASE WHEN id <= 0 THEN 'VAL-07 id' END, CASE WHEN trim(name) = '' THEN 'VAL-07 name' END)
       AS failed_rules FROM node""")
def val07(spark, sf):
    """Category trees of four levels, flattened; bad ids and names stand at the bottom."""
    nodes = V.flatten_categories(adapter.category_trees(spark, sf), ["doc_id"])
    valid, rejects = V.validate(nodes, V.category_rules())
    cols = ["doc_id", "depth", "path", "id"]
    return valid.select(*cols, F.lit("").alias("failed_rules")).unionByName(
        rejects.select(*cols, F.array_join("failed_rules", ", ").alias("failed_rules")))


def flat_products(spark, sf):
    """Flat product records (second platform shape) from the offers: text-typed
    numbers, http image URLs, barcodes with punctuation."""
    o = adapter.offers(spark, sf)
    return o.select(
        F.col("product_id").alias("productId"), F.concat(F.lit(" "), "product_name").alias("productName"),
        F.col("price").cast("string").alias("price"), F.col("list_price").cast("string").alias("listPrice"),
        (F.col("available_quantity") > 0).alias("available"), F.col("available_quantity").alias("stock"),
        F.col("brand").alias("brand"),
        F.when(F.col("ean").isNotNull(), F.concat(F.substring("ean", 1, 6), F.lit("-"), F.substring("ean", 7, 7)))
         .alias("ean"),
        F.concat(F.lit("http://img.example/"), F.col("product_id"), F.lit(".jpg")).alias("imageUrl"),
        F.col("product_url").alias("productUrl"), F.col("supermarket").alias("storeId"),
        F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss").alias("scrapedAt"), F.lit(None).cast("string").alias("platform"))


@register("VAL-08", with_ctes(["obs"], _rules_sql({
    "VAL-08 productId": "trim(product_id) <> ''",
    "VAL-08 productName": "trim(product_name) <> ''",
    "VAL-08 price": "price > 0",
    "VAL-08 listPrice": "list_price >= price",
    "VAL-08 stock": "available_quantity >= 0"}, "obs")))
def val08(spark, sf):
    f = V.normalize_flat(flat_products(spark, sf))
    return V.rule_counts(f, V.flat_product_rules())


@register("VAL-09", with_ctes(["refraw"], """
SELECT lower(trim(nutriscore_grade)) IN ('a','b','c','d','e') AS valid_grade, length(code) IN (8, 13, 14) AS valid_code,
       count(*) AS records,
       count(*) FILTER (WHERE lower(trim(nutriscore_grade)) IN ('a','b','c','d','e')) AS graded
FROM refraw GROUP BY ALL"""))
def val09(spark, sf):
    r = V.normalize_reference(adapter.reference_products(spark, sf))
    return r.groupBy(F.col("nutriscore_grade").isNotNull().alias("valid_grade"),
                     V.reference_rules()["VAL-09 code"].alias("valid_code")).agg(
        F.count(F.lit(1)).alias("records"), F.count("nutriscore_grade").alias("graded"))


@register("VAL-10", with_ctes(["obs"], f"""
SELECT run_id, supermarket AS store, count(*) AS rows,
       CASE WHEN count(*) >= {500} THEN 'OK' ELSE 'LOW VOLUME' END AS status
FROM obs GROUP BY run_id, supermarket"""))
def val10(spark, sf):
    return V.run_volume(_wh(spark, sf).bronze())
