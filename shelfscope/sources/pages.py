"""Extraction from fetched pages and sitemaps as Columns (SRC-14 .. SRC-20).

Regular expressions locate the markup, JSON functions read it; no Python UDF.
JSON-LD by regex is safe for well-formed <script> blocks; a malformed block
yields NULL fields and is counted, not raised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import force_https, parse_price_text

LD_RE = r'<script[^>]*application/ld\+json[^>]*>(.*?)</script>'
PRODUCT_ID_RE = r"-(\d+)/p$"


def _j(block: Column, path: str) -> Column:
    return F.get_json_object(block, path)


def product_block() -> Column:
    """The first JSON-LD Product block of ``html``, else NULL."""
    blocks = F.regexp_extract_all("html", F.lit(LD_RE), 1)
    return F.get(F.filter(blocks, lambda x: F.coalesce(_j(x, "$['@type']") == "Product", F.lit(False))), 0)


def jsonld_products(pages: DataFrame) -> DataFrame:
    """SRC-15: the first JSON-LD block whose @type is Product, per page (row-local)."""
    return pages.select("page_id", "url", product_block().alias("block")).where(F.col("block").isNotNull())


def _ld_price(b: Column) -> Column:
    return F.coalesce(_j(b, "$.offers.price"), _j(b, "$.offers[0].price")).try_cast("double")


def _ld_high(b: Column) -> Column:
    return F.coalesce(_j(b, "$.offers.highPrice"), _j(b, "$.offers[0].highPrice")).try_cast("double")


def normalize_jsonld(products: DataFrame) -> DataFrame:
    """SRC-20: offers object-or-list, brand object-or-string, image list-or-string,
    id from sku or URL, stock 999 (in stock) / 0."""
    b = F.col("block")
    avail = F.coalesce(_j(b, "$.offers.availability"), _j(b, "$.offers[0].availability"))
    brand = F.coalesce(_j(b, "$.brand.name"), _j(b, "$.brand"))
    image = F.coalesce(_j(b, "$.image[0]"), _j(b, "$.image"))
    pid = F.coalesce(_j(b, "$.sku"), F.nullif(F.regexp_extract("url", PRODUCT_ID_RE, 1), F.lit("")))
    in_stock = F.coalesce(avail.contains("InStock"), F.lit(False))
    return products.select(
        "page_id", "url",
        pid.alias("product_id"),
        _j(b, "$.name").alias("name"),
        brand.alias("brand"),
        _ld_price(b).alias("price"),
        _ld_high(b).alias("list_price"),
        _j(b, "$.gtin13").alias("ean"),
        force_https(image).alias("image_url"),
        in_stock.alias("available"),
        F.when(in_stock, 999).otherwise(0).alias("stock"),
        _j(b, "$.name").isNull().alias("malformed"),
    )


def _prop(name: str) -> Column:
    return F.nullif(F.regexp_extract("html", rf'itemprop="{name}"[^>]*content="([^"]*)"', 1), F.lit(""))


def microdata(pages: DataFrame) -> DataFrame:
    """SRC-16: itemprop name/brand/category/price/gtin*/image/availability."""
    return pages.select(
        "page_id", "url",
        _prop("name").alias("name"), _prop("brand").alias("brand"), _prop("category").alias("category"),
        _prop("price").try_cast("double").alias("price"),
        F.coalesce(_prop("gtin13"), _prop("gtin14"), _prop("gtin")).alias("ean"),
        _prop("image").alias("image_url"), _prop("availability").alias("availability"),
    ).where(F.col("name").isNotNull() | F.col("price").isNotNull())


def _css() -> tuple[Column, Column, Column]:
    return (F.nullif(F.trim(F.regexp_extract("html", r"<h1[^>]*>(.*?)</h1>", 1)), F.lit("")),
            parse_price_text(F.regexp_extract("html", r'class="price-selling"[^>]*>([^<]*)<', 1)),
            parse_price_text(F.regexp_extract("html", r'class="price-list"[^>]*>([^<]*)<', 1)))


def css_prices(pages: DataFrame) -> DataFrame:
    """SRC-17: h1 name and the selling / list price text ("R$ 1.234,56" -> 1234.56);
    keeps pages with a name and a positive price."""
    name, sell, lst = _css()
    out = pages.select("page_id", "url", name.alias("name"), sell.alias("price"), lst.alias("list_price"))
    return out.where(F.col("name").isNotNull() & (F.col("price") > 0))


def live_prices(pages: DataFrame) -> DataFrame:
    """SRC-18: current price and discount of a fetched page for deal re-checks:
    JSON-LD price/highPrice, else the CSS selling/list prices."""
    b = F.col("block")
    name, sell, lst = _css()
    shown = name.isNotNull() & (sell > 0)
    j = pages.withColumn("block", product_block()).select(
        "page_id", "url", "status", _ld_price(b).alias("ld_price"), _ld_high(b).alias("ld_high"),
        F.when(shown, sell).alias("css_price"), F.when(shown, lst).alias("css_list"))
    use_ld = F.col("ld_price").isNotNull()
    price = F.when(use_ld, F.col("ld_price")).otherwise(F.col("css_price"))
    high = F.when(use_ld, F.col("ld_high")).otherwise(F.col("css_list"))
    disc = F.when(high > price, (high - price) / high * 100).otherwise(F.lit(0.0))
    return j.select("page_id", "url", "status", price.alias("live_price"),
                    F.when(price.isNotNull(), disc).alias("live_discount_pct"),
                    F.when(use_ld, "jsonld").when(F.col("css_price").isNotNull(), "css").alias("source"))


def sitemap_urls(sitemaps: DataFrame) -> DataFrame:
    """SRC-14: <loc> and <lastmod> of every <url>; product URLs only, id from '-(digits)/p'."""
    entries = sitemaps.select("sitemap_id", F.explode(F.regexp_extract_all("xml", F.lit(r"<url>(.*?)</url>"), 1))
                              .alias("entry"))
    loc = F.regexp_extract("entry", r"<loc>([^<]*)</loc>", 1)
    lastmod = F.nullif(F.regexp_extract("entry", r"<lastmod>([^<]*)</lastmod>", 1), F.lit(""))
    out = entries.select("sitemap_id", loc.alias("url"), lastmod.alias("lastmod_text"))
    out = out.where(F.col("url").rlike(PRODUCT_ID_RE))
    return out.select("sitemap_id", "url", F.regexp_extract("url", PRODUCT_ID_RE, 1).alias("product_id"),
                      F.regexp_extract("url", r"https?://(?:www\.)?([^./]+)", 1).alias("store"),
                      "lastmod_text", F.col("lastmod_text").try_cast("date").alias("lastmod"))


def graphql_products(docs: DataFrame) -> DataFrame:
    """SRC-19: GraphQL product documents -> flat rows (two response variants)."""
    schema = ("id string, name string, sku string, pricing struct<price:double, listPrice:double>, "
              "price double, quantity int, image struct<url:string>, imageUrl string, "
              "categories array<struct<name:string>>")
    p = docs.select("doc_id", F.from_json("json", schema).alias("p"))
    return p.select(
        "doc_id", F.coalesce("p.id", "p.sku").alias("product_id"), F.col("p.name").alias("name"),
        F.coalesce("p.pricing.price", "p.price").alias("price"),
        F.coalesce("p.pricing.listPrice", "p.pricing.price", "p.price").alias("list_price"),
        F.col("p.quantity").alias("stock"),
        force_https(F.coalesce("p.image.url", "p.imageUrl")).alias("image_url"),
        F.transform("p.categories", lambda c: c["name"]).alias("categories"))
