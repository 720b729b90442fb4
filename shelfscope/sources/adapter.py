"""Driver tables -> the reference's data shapes.

The driver supplies TPC-H-like tables, not landed product scrapes. These
functions derive, with plain DataFrame expressions, the inputs the reference
consumes: nested product records per store x region x scrape (bronze), barcode
reference records, a scrape run / batch log, product pages and a sitemap.
Every derived row comes from a driver row, so the work grows with the tables.

Mapping (one lineitem row = one SKU offer):
  product_id   = l_partkey                 name/brand from part
  supermarket  = stores[l_suppkey mod 5]   region = regions[l_orderkey mod 8]
  scraped_at   = 2026-01-01 + (days(l_shipdate - 1995-01-01) mod 60) + l_linenumber h
  ListPrice    = floor(round(l_extendedprice*100) / l_quantity) cents
  Price        = floor(ListPrice_cents * (100 - discount_points * (l_partkey mod 10)) / 100) cents
  quantity     = l_quantity - 3            ean = lpad(l_partkey, 13, '0') unless l_partkey mod 3 = 0
Prices are whole cents so every engine computes identical doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from .tables import read_table, spread


def _pick(values: list[str], idx: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), idx)


def _store_idx() -> Column:
    return F.pmod(F.col("l_suppkey"), F.lit(len(config.ADAPTER_STORES))).cast("int")


def _region_idx() -> Column:
    return F.pmod(F.col("l_orderkey"), F.lit(len(config.ADAPTER_REGIONS))).cast("int")


def offers(spark: SparkSession, sf_dir: str, lay: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One flat SKU offer per lineitem row (product x store x region x scrape).

    ``lay`` shuffles the rows while they are narrow (before names, addresses and SKUs are made of
    them), by any of supermarket, region, year, month and day; without it they lie by product."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size")
    # part grows with the data. A merge join shuffles the rows while they are narrow, which also deals
    # a table of few splits to all cores, and puts the wide rows of a product side by side. The key is the
    # product's id, so that Spark knows it: what groups by product needn't shuffle the wide rows again.
    df = li.withColumn("_product", F.col("l_partkey").cast("string")).join(
        part.withColumn("_product", F.col("p_partkey").cast("string")).hint("merge"), "_product", "inner")

    sidx, ridx = _store_idx(), _region_idx()
    store = _pick(config.ADAPTER_STORES, sidx)
    region = _pick(config.ADAPTER_REGIONS, ridx)
    day_off = F.pmod(F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")), F.lit(60))
    scraped_at = F.timestamp_seconds(
        (F.unix_date(F.lit("2026-01-01").cast("date")) + day_off).cast("bigint") * 86400
        + F.col("l_linenumber").cast("bigint") * 3600)
    list_cents = F.expr("cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)")
    name = (F.when(sidx == 1, F.upper("p_name"))
            .when(sidx == 3, F.replace(F.col("p_name"), F.lit(" "), F.lit("  ")))
            # own-brand names that no other store has
            .when((sidx == 4) & (F.pmod("l_partkey", F.lit(17)) == 0),
                  F.concat("p_name", F.lit(" giassi "), F.col("l_partkey").cast("string")))
            .otherwise(F.col("p_name")))
    pid = F.col("_product")
    if lay is not None:
        keys = {"supermarket": store, "region": region, "year": F.year(scraped_at),
                "month": F.month(scraped_at), "day": F.dayofmonth(scraped_at)}
        df = lay(df.withColumns(keys))
        store, region = F.col("supermarket"), F.col("region")
    return df.select(
        pid.alias("product_id"),
        name.alias("product_name"),
        F.when(F.pmod("l_partkey", F.lit(11)) != 0, F.col("p_brand")).alias("brand"),
        F.concat(F.lit("https://www."), store, F.lit(".com.br/"),
                 F.replace(F.lower("p_name"), F.lit(" "), F.lit("-")), F.lit("-"), pid, F.lit("/p")).alias("product_url"),
        store.alias("supermarket"),
        region.alias("region"),
        _pick([r[1] for r in config.REGION_SEED], ridx).alias("postal_code"),
        _pick([r[3] for r in config.REGION_SEED], ridx).alias("hub_id"),
        scraped_at.alias("scraped_at"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("item_id"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_size").cast("string"), F.lit("g")).alias("item_name"),
        F.when(F.pmod("l_partkey", F.lit(3)) != 0, F.lpad(pid, 13, "0")).alias("ean"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_linenumber").alias("line_number"),
        (F.expr("(cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint))"
                " * (100 - cast(round(l_discount * 100) as bigint) * pmod(l_partkey, 10)) div 100") / 100.0
         ).alias("price"),
        (list_cents / 100.0).alias("list_price"),
        (F.col("l_quantity").cast("int") - 3).alias("available_quantity"),
        *[F.col(c) for c in (() if lay is None else ("year", "month", "day"))],
    ).withColumn("run_id", F.concat(F.col("supermarket"), F.lit("_"),
                                    F.date_format("scraped_at", "yyyyMMddHH")))


def bronze_products(spark: SparkSession, sf_dir: str, lay: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Nested product records (bronze shape), one per landed product page.

    Each lineitem row is one landed record: its ``items`` array holds the SKU of
    that row and, on even line numbers, a two-pack SKU (double price and list
    price, half the stock, no barcode). Built row by row — no shuffle, no
    grouping — so no record can grow with a hot key. Columns follow the landed
    layout: camelCase payload, flattened ``_metadata_*`` lineage columns and the
    Hive partition columns supermarket/region/year/month/day. ``lay`` as in ``offers``.
    """
    o = offers(spark, sf_dir, lay)

    def seller(price, list_price, qty):
        return F.array(F.struct(
            F.col("seller_id").alias("sellerId"),
            F.concat(F.lit("Seller "), F.col("seller_id")).alias("sellerName"),
            F.struct(price.alias("Price"), list_price.alias("ListPrice"),
                     qty.alias("AvailableQuantity")).alias("commertialOffer"),
        ))

    single = F.struct(
        F.col("item_id").alias("itemId"),
        F.col("item_name").alias("name"),
        F.col("ean").alias("ean"),
        seller(F.col("price"), F.col("list_price"), F.col("available_quantity")).alias("sellers"),
    )
    pack = F.struct(
        F.concat(F.col("item_id"), F.lit("-x2")).alias("itemId"),
        F.concat(F.col("item_name"), F.lit(" x2")).alias("name"),
        F.lit(None).cast("string").alias("ean"),
        seller(F.col("price") * 2, F.col("list_price") * 2,
               F.floor(F.col("available_quantity") / 2).cast("int")).alias("sellers"),
    )
    # one array expression (a CASE would repeat the SKU struct in both branches and
    # double the generated code of every stage that reads it)
    items = F.slice(F.array(single, pack), 1, F.when(F.col("line_number") % 2 == 0, 2).otherwise(1))
    return o.select(
        F.col("product_id").alias("productId"),
        F.col("product_name").alias("productName"),
        "brand",
        F.col("product_url").alias("link"),
        F.regexp_replace(F.lower(F.col("product_name")), " +", "-").alias("linkText"),
        items.alias("items"),
        F.col("supermarket").alias("_metadata_supermarket"),
        F.col("region").alias("_metadata_region"),
        F.col("postal_code").alias("_metadata_postal_code"),
        F.col("hub_id").alias("_metadata_hub_id"),
        F.col("run_id").alias("_metadata_run_id"),
        F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss").alias("_metadata_scraped_at"),
        "supermarket", "region",
        *([F.year("scraped_at").alias("year"), F.month("scraped_at").alias("month"),
           F.dayofmonth("scraped_at").alias("day")] if lay is None else ["year", "month", "day"]),
    )


def reference_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcode reference records (bronze of the product database), from ``part``.

    Half of the barcoded products (l_partkey mod 3 <> 0 and even) have a record;
    every fourth has an older second record with another name (latest wins);
    every seventh carries a 12-digit code (rejected by the length rule). Grade
    letters run A..F ('F' is not a valid grade).
    """
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size",
                      "p_retailprice")
    k = F.col("p_partkey")
    base = part.where((F.pmod(k, F.lit(3)) != 0) & (F.pmod(k, F.lit(2)) == 0))
    code = F.when(F.pmod(k, F.lit(7)) == 0, F.lpad(k.cast("string"), 12, "0")) \
            .otherwise(F.lpad(k.cast("string"), 13, "0"))

    def rec(name, run_id, ts):
        return F.struct(
            name.alias("product_name"), ts.alias("_metadata_scraped_at"), F.lit(run_id).alias("_metadata_run_id"))

    versions = F.when(F.pmod(k, F.lit(4)) == 0, F.array(
        rec(F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")), "ref_2026_02", F.lit("2026-02-01T00:00:00")),
        rec(F.concat(F.lit("old "), F.col("p_name")), "ref_2026_01", F.lit("2026-01-01T00:00:00")),
    )).otherwise(F.array(
        rec(F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")), "ref_2026_02", F.lit("2026-02-01T00:00:00"))))
    grade = F.get(F.array(*[F.lit(x) for x in "ABCDEF"]), F.pmod(k, F.lit(6)).cast("int"))
    r = base.select(code.alias("code"), F.explode(versions).alias("v"), "p_brand", "p_type", "p_size",
                    "p_retailprice", grade.alias("grade"))
    return r.select(
        "code",
        F.col("v.product_name").alias("product_name"),
        F.concat(F.col("p_brand"), F.lit(" ")).alias("brands"),
        F.col("p_type").alias("categories"),
        F.concat(F.col("p_size").cast("string"), F.lit(" g")).alias("quantity"),
        F.lit("Brasil").alias("countries"),
        F.col("grade").alias("nutriscore_grade"),
        F.struct(F.col("p_retailprice").alias("energy_100g"),
                 (F.col("p_size") / 10.0).alias("proteins_100g")).alias("nutriments"),
        F.lit(None).cast("string").alias("ingredients_text"),
        F.lit(None).cast("string").alias("allergens"),
        F.lit(None).cast("string").alias("labels"),
        F.lit(None).cast("string").alias("packaging"),
        F.lit(None).cast("string").alias("image_url"),
        F.col("v._metadata_run_id").alias("_metadata_run_id"),
        F.col("v._metadata_scraped_at").alias("_metadata_scraped_at"),
    )


def scraper_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch log (one API batch per driver event).

    run = user x day; store = stores[user mod 5]; region = regions[user mod 8];
    response time = value x 100 ms (whole ms); an 'error' event is a failed
    batch (HTTP 500, one retry).
    """
    ev = spread(read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")) \
        .withColumn("ts", F.col("ts").cast("timestamp"))  # no zone in the data: session zone is UTC
    u = F.col("user_id")
    rt = F.round(F.col("value") * 100, 0)
    err = F.col("event_type") == "error"
    return ev.select(
        F.concat(F.lit("b"), F.col("event_id").cast("string")).alias("batch_id"),
        F.concat(F.lit("run_"), u.cast("string"), F.lit("_"), F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        F.col("event_id").alias("batch_number"),
        _pick(config.ADAPTER_STORES, F.pmod(u, F.lit(len(config.ADAPTER_STORES))).cast("int")).alias("store"),
        _pick(config.ADAPTER_REGIONS, F.pmod(u, F.lit(len(config.ADAPTER_REGIONS))).cast("int")).alias("region"),
        _pick(["sitemap", "category", "fallback"], F.pmod(u, F.lit(3)).cast("int")).alias("discovery_mode"),
        F.col("ts").alias("started_at"),
        F.timestamp_micros(F.unix_micros("ts") + (rt * 1000).cast("bigint")).alias("finished_at"),
        (F.pmod(F.col("event_id"), F.lit(50)) + 1).cast("int").alias("products_count"),
        F.when(err, 500).otherwise(200).alias("api_status_code"),
        rt.alias("response_time_ms"),
        F.when(err, 1).otherwise(0).alias("retry_count"),
        (~err).alias("success"),
        (F.col("event_type") == "view").alias("_view"),
        (F.col("event_type") == "signup").alias("_signup"),
    )


def run_events(batches: DataFrame) -> DataFrame:
    """Run lifecycle log: start, discovery and finish events per run (what a
    collector appends while it runs). The finish event omits the discovered
    count, as the reference's finish_run call may."""
    r = batches.groupBy("run_id").agg(
        F.first("store").alias("store"), F.first("region").alias("region"),
        F.first("discovery_mode").alias("discovery_mode"),
        F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at"),
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("success")).alias("errors"),
        F.sum("products_count").alias("products"),
        F.sum(F.when(F.col("success"), F.col("products_count")).otherwise(0)).alias("scraped"),
        F.count_if("_view").alias("views"), F.count_if("_signup").alias("signups"),
    )
    null = lambda t: F.lit(None).cast(t)
    failed = F.col("errors") * 2 > F.col("n")
    common = [F.col("run_id")]
    start = r.select(*common, F.lit("start").alias("event"), F.col("started_at").alias("event_ts"),
                     "store", "region", F.col("started_at").alias("started_at"), null("timestamp").alias("finished_at"),
                     F.lit("running").alias("status"), null("string").alias("discovery_mode"),
                     null("double").alias("discovery_duration_seconds"), null("bigint").alias("products_discovered"),
                     null("bigint").alias("products_scraped"), null("bigint").alias("bytes_downloaded"),
                     null("bigint").alias("api_calls_count"), null("bigint").alias("api_errors_count"),
                     null("bigint").alias("validation_errors_count"), null("double").alias("duration_seconds"),
                     null("string").alias("error_message"))
    disc = r.select(*common, F.lit("discovery").alias("event"),
                    F.timestamp_micros(F.unix_micros("started_at") + 1).alias("event_ts"),
                    null("string").alias("store"), null("string").alias("region"), null("timestamp").alias("started_at"),
                    null("timestamp").alias("finished_at"), F.lit("running").alias("status"), "discovery_mode",
                    (F.col("n").cast("double") * 1.5).alias("discovery_duration_seconds"),
                    (F.col("products") + F.col("views")).alias("products_discovered"),
                    null("bigint").alias("products_scraped"), null("bigint").alias("bytes_downloaded"),
                    null("bigint").alias("api_calls_count"), null("bigint").alias("api_errors_count"),
                    null("bigint").alias("validation_errors_count"), null("double").alias("duration_seconds"),
                    null("string").alias("error_message"))
    fin = r.select(*common, F.lit("finish").alias("event"),
                   F.timestamp_micros(F.unix_micros("finished_at") + 2).alias("event_ts"),
                   null("string").alias("store"), null("string").alias("region"), null("timestamp").alias("started_at"),
                   "finished_at", F.when(failed, "failed").otherwise("success").alias("status"),
                   null("string").alias("discovery_mode"), null("double").alias("discovery_duration_seconds"),
                   null("bigint").alias("products_discovered"), F.col("scraped").alias("products_scraped"),
                   (F.col("products") * 2048).alias("bytes_downloaded"), F.col("n").alias("api_calls_count"),
                   F.col("errors").alias("api_errors_count"), F.col("signups").alias("validation_errors_count"),
                   ((F.unix_micros("finished_at") - F.unix_micros("started_at")).cast("double") / 1e6)
                   .alias("duration_seconds"),
                   F.when(failed, F.lit("api errors")).alias("error_message"))
    return start.unionByName(disc).unionByName(fin)


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched product pages: one per part (store = partkey mod 5), HTML built by
    string concatenation, unioned with the driver's ``pages`` (no product markup).

    Markup varies the way real stores do: a breadcrumb JSON-LD block before the
    Product block; brand as object (even keys) or string; offers as object or
    list (every third key); image as list or string; every 13th page carries a
    truncated (malformed) Product block; microdata itemprops; CSS selling/list
    price text in Brazilian format ("R$ 1.234,56"); no JSON-LD at all on every
    17th page (CSS only).
    """
    part = spread(read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_retailprice"))
    k = F.col("p_partkey")
    ks = k.cast("string")
    store = _pick(config.ADAPTER_STORES, F.pmod(k, F.lit(5)).cast("int"))
    list_c = F.round(F.col("p_retailprice") * 100).cast("bigint")
    price_c = F.expr("cast(round(p_retailprice * 100) as bigint) * (10 - pmod(p_partkey, 4)) div 10")
    money = lambda c: F.format_string("%d.%02d", (c / 100).cast("bigint"), F.pmod(c, F.lit(100)))
    br = lambda c: F.translate(F.format_number(c / 100.0, 2), ",.", ".,")
    url = F.concat(F.lit("https://www."), store, F.lit(".com.br/"), F.replace(F.lower("p_name"), F.lit(" "), F.lit("-")),
                   F.lit("-"), ks, F.lit("/p"))
    ean = F.lpad(ks, 13, "0")
    brand = F.when(F.pmod(k, F.lit(2)) == 0,
                   F.concat(F.lit('{"@type":"Brand","name":"'), F.col("p_brand"), F.lit('"}'))) \
             .otherwise(F.concat(F.lit('"'), F.col("p_brand"), F.lit('"')))
    offer = F.concat(F.lit('{"@type":"Offer","price":"'), money(price_c), F.lit('","highPrice":"'), money(list_c),
                     F.lit('","priceCurrency":"BRL","availability":"https://schema.org/'),
                     F.when(F.pmod(k, F.lit(7)) == 0, F.lit("OutOfStock")).otherwise(F.lit("InStock")), F.lit('"}'))
    offers = F.when(F.pmod(k, F.lit(3)) == 0, F.concat(F.lit("["), offer, F.lit("]"))).otherwise(offer)
    img = F.concat(F.lit("http://img.example/"), ks, F.lit(".jpg"))
    image = F.when(F.pmod(k, F.lit(2)) == 1, F.concat(F.lit('["'), img, F.lit('"]'))) \
             .otherwise(F.concat(F.lit('"'), img, F.lit('"')))
    product = F.concat(F.lit('{"@context":"https://schema.org","@type":"Product","name":"'), F.col("p_name"),
                       F.lit('","sku":"'), ks, F.lit('","gtin13":"'), ean, F.lit('","brand":'), brand,
                       F.lit(',"image":'), image, F.lit(',"offers":'), offers, F.lit("}"))
    product = F.when(F.pmod(k, F.lit(13)) == 0, F.substring(product, 1, 60)).otherwise(product)
    ld = F.when(F.pmod(k, F.lit(17)) == 0, F.lit("")).otherwise(F.concat(
        F.lit('<script type="application/ld+json">{"@context":"https://schema.org","@type":"BreadcrumbList"}</script>'),
        F.lit('<script type="application/ld+json">'), product, F.lit("</script>")))
    html = F.concat(
        F.lit("<html><head><title>"), F.col("p_name"), F.lit("</title>"), ld, F.lit("</head><body>"),
        F.lit('<h1 class="product-name">'), F.col("p_name"), F.lit("</h1>"),
        F.lit('<div itemscope itemtype="https://schema.org/Product"><meta itemprop="name" content="'), F.col("p_name"),
        F.lit('"><meta itemprop="brand" content="'), F.col("p_brand"), F.lit('"><meta itemprop="gtin13" content="'), ean,
        F.lit('"><meta itemprop="price" content="'), money(price_c), F.lit('"></div>'),
        F.lit('<div class="price-selling">R$ '), br(price_c), F.lit('</div><div class="price-list">R$ '), br(list_c),
        F.lit("</div></body></html>"))
    synth = part.select((k + 1000000000).alias("page_id"), url.alias("url"), html.alias("html"), F.lit(200).alias("status"))
    real = read_table(spark, sf_dir, "pages", "page_id", "url", "html").withColumn("status", F.lit(200))
    return synth.unionByName(real)


def sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemap documents: one <urlset> per part listing its product page in every
    store plus a category page; lastmod spread over the last 60 days (every
    11th entry has none, every 19th an invalid date)."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name")
    k = F.col("p_partkey")
    slug = F.replace(F.lower("p_name"), F.lit(" "), F.lit("-"))
    lastmod = (F.when(F.pmod(k, F.lit(11)) == 0, F.lit(""))
                .when(F.pmod(k, F.lit(19)) == 0, F.lit("<lastmod>not-a-date</lastmod>"))
                .otherwise(F.concat(F.lit("<lastmod>"),
                                    F.date_format(F.date_sub(F.lit("2026-03-01").cast("date"),
                                                             F.pmod(k, F.lit(60)).cast("int")), "yyyy-MM-dd"),
                                    F.lit("</lastmod>"))))
    entries = [F.concat(F.lit("<url><loc>https://www."), F.lit(s), F.lit(".com.br/"), slug, F.lit("-"),
                        k.cast("string"), F.lit("/p</loc>"), lastmod, F.lit("</url>")) for s in config.ADAPTER_STORES]
    cat = F.concat(F.lit("<url><loc>https://www.bistek.com.br/category/"), slug, F.lit("</loc></url>"))
    xml = F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), *entries, cat,
                   F.lit("</urlset>"))
    return part.select(k.alias("sitemap_id"), xml.alias("xml"))


def graphql_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GraphQL product responses (two variants) built from ``part`` as JSON text:
    even keys {id, name, pricing{price, listPrice}, quantity, image{url}, categories[]},
    odd keys {sku, name, price, quantity, imageUrl, categories[]}."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_retailprice", "p_size")
    k = F.col("p_partkey")
    price = F.expr("(cast(round(p_retailprice * 100) as bigint) * 9 div 10) / 100.0")
    cats = F.array(F.struct(F.col("p_type").alias("name")), F.struct(F.lit("All").alias("name")))
    a = F.to_json(F.struct(k.cast("string").alias("id"), F.col("p_name").alias("name"),
                           F.struct(price.alias("price"), F.col("p_retailprice").alias("listPrice")).alias("pricing"),
                           F.col("p_size").alias("quantity"),
                           F.struct(F.concat(F.lit("http://img.example/"), k.cast("string")).alias("url")).alias("image"),
                           cats.alias("categories")))
    b = F.to_json(F.struct(k.cast("string").alias("sku"), F.col("p_name").alias("name"), price.alias("price"),
                           F.col("p_size").alias("quantity"),
                           F.concat(F.lit("http://img.example/"), k.cast("string")).alias("imageUrl"),
                           F.array(F.struct(F.col("p_type").alias("name"))).alias("categories")))
    return part.select(k.alias("doc_id"), F.when(F.pmod(k, F.lit(2)) == 0, a).otherwise(b).alias("json"))


# Delta files of the barcode database: their time ranges. Every product changes in one of them.
DELTA_RANGES = [(1700000000, 1700000999), (1700001000, 1700001999), (1700002000, 1700002999)]


def reference_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the delta files, with the number of their file (``file``).

    Product k is in file (k div 3) mod 3, so every file holds wanted barcodes. Every fifth
    one (k mod 5 = 0) has the name 'unknown'; of the rest, even ones carry a list of names and
    odd ones a text. k mod 4 = 2 repeats what the database already says.
    """
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand")
    k = F.col("p_partkey")
    grade = F.get(F.array(*[F.lit(x) for x in "abcdef"]), F.pmod(k, F.lit(6)).cast("int"))
    same = F.pmod(k, F.lit(4)) == 2
    name = (F.when(same, F.col("p_name"))
            .when(F.pmod(k, F.lit(5)) == 0, F.lit("unknown"))
            .when(F.pmod(k, F.lit(2)) == 0,
                  F.to_json(F.array(F.struct(F.lit("pt").alias("lang"), F.concat(F.lit("new "), "p_name").alias("text")))))
            .otherwise(F.concat(F.lit("new "), "p_name")))
    number = F.pmod(F.floor(k / 3), F.lit(3)).cast("int")
    return part.select(
        number.alias("file"), F.lpad(k.cast("string"), 13, "0").alias("code"), name.alias("product_name"),
        F.col("p_brand").alias("brands"), F.when(same, F.when(grade != "f", grade)).otherwise("a").alias("nutriscore_grade"),
        (F.lit(1700000000) + number * 1000 + F.pmod(k, F.lit(100))).cast("long").alias("last_modified_t"))


def land_deltas(spark: SparkSession, sf_dir: str, base: str) -> str:
    """The delta files under ``base``, one folder of gzipped JSON lines per time range."""
    recs = reference_deltas(spark, sf_dir)
    for i, (start, end) in enumerate(DELTA_RANGES):
        (recs.where(F.col("file") == i).drop("file").write.mode("overwrite").option("compression", "gzip")
         .json(f"{base}/delta_{start}_{end}.json.gz"))
    return base


def category_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category trees as JSON text, one per part: its type, below it its brand, below that the
    second word of its name, and below that the first word and the size. Bad nodes stand at the
    bottom: the first word's id is not positive where k mod 7 = 0, the size's name is blank where
    k mod 11 = 0; the second level has a leaf of its own, and every fifth tree has no fourth level."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_brand", "p_size")
    k = F.col("p_partkey")
    word = lambda i: F.get(F.split("p_name", " "), F.lit(i))

    def node(number: int, name: Column, children: Column | None = None, id_: Column | None = None) -> Column:
        fields = [(id_ if id_ is not None else k * 10 + number).alias("id"), name.alias("name"),
                  (F.lit(False) if children is None else F.size(children) > 0).alias("hasChildren")]
        return F.struct(*fields, *([] if children is None else [children.alias("children")]))

    leaves = F.array(node(4, word(0), id_=F.when(F.pmod(k, F.lit(7)) == 0, -k).otherwise(k * 10 + 4)),
                     node(5, F.when(F.pmod(k, F.lit(11)) == 0, F.lit("  ")).otherwise(F.concat(F.lit("size "), F.col("p_size").cast("string")))))
    # arrays hold nodes of one type, so a leaf beside them has an empty list of children
    third = F.array(node(3, word(1), F.slice(leaves, 1, F.when(F.pmod(k, F.lit(5)) != 0, 2).otherwise(0))))
    second = F.array(node(2, F.col("p_brand"), third), node(6, F.lit("Other"), F.slice(third, 1, 0)))
    return part.select(k.alias("doc_id"), F.to_json(F.array(node(1, F.col("p_type"), second))).alias("json"))


def full_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed product records in the full payload shape: offers with price without discount,
    reward, tax and a list of promotions, items with images. One record per lineitem row,
    built row by row. Faulty values, by order key o and line l: price without discount below the
    price (o mod 13 = 0), a negative tax (o mod 17 = 0), a negative reward (o mod 19 = 0), a
    percentage above 100 in the second promotion (o mod 23 = 0), a negative discount in the
    first (o mod 29 = 0), a blank image address (o mod 31 = 0); even lines have images by http."""
    li = spread(read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                           "l_extendedprice", "l_discount"))
    o, ln = F.col("l_orderkey"), F.col("l_linenumber")
    hit = lambda n: F.pmod(o, F.lit(n)) == 0
    price = F.expr("(cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)) / 100.0")
    pct = F.round(F.col("l_discount") * 100, 0)

    def promotion(number: int, value: Column, percentage: Column) -> Column:
        return F.struct(F.concat(F.lit(f"P{number}-"), o.cast("string")).alias("promotionId"),
                        value.alias("discountValue"), percentage.alias("discountPercentage"))

    promos = F.slice(F.array(
        promotion(1, F.when(hit(29), F.lit(-1.0)).otherwise(F.col("l_discount")), pct),
        promotion(2, F.lit(None).cast("double"), F.when(hit(23), pct + 101).otherwise(pct))),
        1, (F.pmod(ln, F.lit(3))).cast("int"))
    offer = F.struct(
        price.alias("Price"), price.alias("ListPrice"),
        F.when(hit(13), price - 0.01).when(F.pmod(ln, F.lit(2)) == 0, price).alias("PriceWithoutDiscount"),
        F.when(hit(19), F.lit(-0.5)).otherwise(0.0).alias("RewardValue"),
        F.when(hit(17), F.lit(-1.0)).when(F.pmod(ln, F.lit(2)) == 1, 0.0).alias("Tax"),
        F.col("l_quantity").cast("int").alias("AvailableQuantity"), promos.alias("Promotions"))

    def item(number: int) -> Column:
        iid = F.concat(o.cast("string"), F.lit("-"), ln.cast("string"), F.lit(f"-{number}"))
        url = F.concat(F.when(F.pmod(ln, F.lit(2)) == 0, "http").otherwise("https"), F.lit("://img.example/"), iid, F.lit(".jpg"))
        images = F.array(F.struct(F.concat(iid, F.lit("-a")).alias("imageId"), url.alias("imageUrl")),
                         F.struct(F.concat(iid, F.lit("-b")).alias("imageId"),
                                  (F.when(hit(31), F.lit(" ")).otherwise(url) if number == 2 else url).alias("imageUrl")))
        seller = F.struct(F.col("l_suppkey").cast("string").alias("sellerId"), offer.alias("commertialOffer"))
        return F.struct(iid.alias("itemId"), F.array(seller).alias("sellers"), images.alias("images"))

    return li.select(
        F.concat(o.cast("string"), F.lit("-"), ln.cast("string")).alias("record_id"), F.col("l_partkey").cast("string").alias("productId"),
        F.slice(F.array(item(1), item(2)), 1, F.when(F.pmod(ln, F.lit(2)) == 0, 2).otherwise(1)).alias("items"))
