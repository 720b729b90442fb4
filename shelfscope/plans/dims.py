"""Conformed dimensions (M-04 .. M-11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions.columns import dow_sunday0
from ..operators.dedup import latest_per_key
from ..operators.keys import sequential_key, small_key


def _lookup(pairs, key: Column) -> Column:
    m = F.create_map(*[x for k, v in pairs for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, key)


# ---------------------------------------------------------------- M-05 / SRC-11
STORE_SCHEMA = T.StructType([
    T.StructField("store_id", T.StringType()), T.StructField("store_name", T.StringType()),
    T.StructField("store_type", T.StringType()), T.StructField("coverage_states", T.StringType()),
    T.StructField("is_active", T.BooleanType()), T.StructField("region_count", T.IntegerType()),
    T.StructField("website_url", T.StringType()),
])


def store_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(config.STORE_SEED, STORE_SCHEMA)


def dim_store(spark: SparkSession) -> DataFrame:
    s = small_key(store_seed(spark), ["store_id"], "store_key")
    t = F.col("store_type")
    return s.select(
        "store_key", "store_id", "store_name", "store_type", "coverage_states", "is_active",
        "region_count", "website_url",
        F.coalesce(_lookup(config.STORE_TYPE_DESCRIPTION.items(), t), F.lit("Unknown")).alias("store_type_description"),
        F.when(t.isin("hypermarket", "supermarket"), "B2C").when(t == "wholesale", "B2B/B2C")
         .otherwise("Unknown").alias("business_segment"),
    )


STORE_REGION_SCHEMA = ("store string, regions map<string, struct<postal_code: string, sc_code: string, hub_id: string>>")


def region_seed(spark: SparkSession) -> DataFrame:
    """SRC-12: the stores' nested configuration as a table keyed by (store, region). Each
    store has regions of its own; a code that two stores share has each store's sales
    channel and hub."""
    nested = spark.createDataFrame(list(config.STORE_REGIONS.items()), STORE_REGION_SCHEMA)
    return nested.select("store", F.explode("regions").alias("region_code", "r")).select(
        "store", "region_code", "r.postal_code", "r.sc_code", "r.hub_id")


# ---------------------------------------------------------------- M-04 / SRC-13
def date_spine(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end, F.expr("interval 1 day")))


def dim_date(tru: DataFrame, as_of: dt.date) -> DataFrame:
    """Calendar from the first scraped day to as_of + 2 years (decision: the start
    is the data's first day, not a fixed date; relative flags use ``as_of``)."""
    a = F.lit(as_of).cast("date")
    bounds = tru.agg(F.min("scraped_date").alias("_start"))
    d = F.col("date_day")
    days = bounds.select(date_spine(F.col("_start"), F.add_months(a, 24)).alias("date_day"))
    q_start = F.to_date(F.date_trunc("quarter", d))
    y_start = F.to_date(F.date_trunc("year", d))
    w_start = F.to_date(F.date_trunc("week", d))
    dow = dow_sunday0(d)
    big = lambda x: x.cast("bigint")
    return days.select(
        d,
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        big(F.dayofmonth(d)).alias("day_of_month"),
        big(dow).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_name_short"),
        big(F.dayofyear(d)).alias("day_of_year"),
        big(F.weekofyear(d)).alias("week_of_year"),
        w_start.alias("week_start_date"),
        F.date_add(w_start, 6).alias("week_end_date"),
        big(F.month(d)).alias("month_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_short"),
        F.trunc(d, "month").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        big(F.quarter(d)).alias("quarter_of_year"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        q_start.alias("quarter_start_date"),
        F.date_sub(F.add_months(q_start, 3), 1).alias("quarter_end_date"),
        big(F.year(d)).alias("year"),
        y_start.alias("year_start_date"),
        F.date_sub(F.add_months(y_start, 12), 1).alias("year_end_date"),
        dow.isin(0, 6).alias("is_weekend"),
        dow.between(1, 5).alias("is_weekday"),
        big(F.when(F.month(d) >= 4, F.year(d)).otherwise(F.year(d) - 1)).alias("fiscal_year"),
        (d == a).alias("is_today"),
        (d == F.date_sub(a, 1)).alias("is_yesterday"),
        d.between(F.date_sub(a, 7), a).alias("is_last_7_days"),
        d.between(F.date_sub(a, 30), a).alias("is_last_30_days"),
        d.between(F.trunc(a, "month"), a).alias("is_month_to_date"),
        d.between(F.trunc(a, "year"), a).alias("is_year_to_date"),
    )


# ---------------------------------------------------------------- M-06
def dim_product(tru: DataFrame) -> DataFrame:
    """Modal name and brand (lowest value on ties), stores carrying it, counts."""
    agg = tru.groupBy("product_id").agg(
        F.mode("product_name", deterministic=True).alias("product_name"),
        F.mode("brand", deterministic=True).alias("brand"),
        # bounded by the number of stores / configured regions
        F.array_sort(F.collect_set("supermarket")).alias("stores_carrying"),
        F.size(F.collect_set("region")).cast("bigint").alias("region_count"),
        F.min("product_url").alias("sample_url"),
    ).withColumn("store_count", F.size("stores_carrying").cast("bigint"))
    return sequential_key(agg, ["product_id"], "product_key").select(
        "product_key", "product_id", "product_name", "brand", "stores_carrying", "store_count",
        "region_count", "sample_url")


# ---------------------------------------------------------------- M-07
def dim_brand(tru: DataFrame, active_stores: int = len(config.STORE_SEED)) -> DataFrame:
    """Brand metrics; distribution level compares with the number of active stores
    (decision: the reference's 3-store constant marks 4 or 5 stores as single-store)."""
    b = tru.where(F.col("brand").isNotNull()).groupBy("brand").agg(
        F.count_distinct("product_id").alias("product_count"),
        F.size(F.collect_set("supermarket")).cast("bigint").alias("store_count"),
        F.min("scraped_date").alias("first_seen_date"),
        F.max("scraped_date").alias("last_seen_date"),
    )
    pc, sc = F.col("product_count"), F.col("store_count")
    b = sequential_key(b, [pc.desc(), F.col("brand")], "brand_key")
    return b.select(
        "brand_key", F.col("brand").alias("brand_name"), "product_count", "store_count",
        F.when(pc >= 100, "Major Brand").when(pc >= 20, "Medium Brand").when(pc >= 5, "Small Brand")
         .otherwise("Niche Brand").alias("brand_tier"),
        F.when(sc >= active_stores, "All Stores").when(sc >= 2, "Multi-store")
         .otherwise("Single Store").alias("distribution_level"),
        "first_seen_date", "last_seen_date",
    )


# ---------------------------------------------------------------- M-08
def dim_region(tru: DataFrame) -> DataFrame:
    """One row per region code (decision: postal codes kept as a sorted array so the
    fact join cannot fan out)."""
    r = tru.where(F.col("region").isNotNull()).groupBy(F.col("region").alias("region_code")).agg(
        F.array_sort(F.collect_set("postal_code")).alias("postal_codes"),
        F.array_sort(F.collect_set("supermarket")).alias("stores_in_region"),
    )
    city = F.split_part(F.col("region_code"), F.lit("_"), F.lit(1))
    rs = city.isin(*config.REGION_RS_CITIES)
    r = r.select(
        "region_code",
        city.alias("city_code"),
        F.coalesce(_lookup(config.REGION_CITY_NAMES, city), city).alias("city_name"),
        F.split_part(F.col("region_code"), F.lit("_"), F.lit(2)).alias("neighborhood_code"),
        F.when(rs, "RS").otherwise("SC").alias("state_code"),
        F.when(rs, "Rio Grande do Sul").otherwise("Santa Catarina").alias("state_name"),
        "postal_codes", "stores_in_region",
        F.size("stores_in_region").cast("bigint").alias("store_count"),
    )
    r = r.withColumn("market_type",
                     F.when(F.col("city_name").isin(*config.MAJOR_CITIES), "Capital/Major City")
                      .when(F.col("store_count") >= 2, "Multi-store Market")
                      .otherwise("Single-store Market"))
    r = small_key(r, ["region_code"], "region_key")
    return r.select("region_key", "region_code", "city_code", "city_name", "neighborhood_code",
                    "state_code", "state_name", "postal_codes", "stores_in_region", "store_count",
                    "market_type")


# ---------------------------------------------------------------- M-09
def parse_location(code: Column) -> tuple[Column, Column, Column]:
    """(city_code, neighborhood_code, matched) for a region code.

    Decision: the longest city key of the lookup that the code starts with (at an
    underscore boundary) wins, so keys with underscores are reachable; otherwise
    the code is cut at its first underscore as in the reference.
    """
    keys = sorted((k for k, _ in config.LOCATION_CITY_NAMES), key=len, reverse=True)
    cand = F.filter(F.array(*[F.lit(k) for k in keys]),
                    lambda k: (code == k) | code.startswith(F.concat(k, F.lit("_"))))
    m = F.get(cand, 0)
    pos = F.instr(code, "_")
    city = F.coalesce(m, F.when(pos > 0, F.substring(code, 1, pos - 1)).otherwise(code))
    after_m = F.substr(code, F.length(m) + 2)
    nb = F.when(m.isNotNull(), F.when(code == m, F.lit("centro")).otherwise(after_m)) \
          .otherwise(F.when(pos > 0, F.substr(code, pos + 1)).otherwise(F.lit("centro")))
    return city, nb, m.isNotNull()


def dim_location(tru: DataFrame) -> DataFrame:
    loc = tru.where(F.col("region").isNotNull()).select(F.col("region").alias("location_id")).distinct()
    city, nb, _ = parse_location(F.col("location_id"))
    loc = loc.select("location_id", city.alias("city_code"), nb.alias("neighborhood_code"))
    cc, nc = F.col("city_code"), F.col("neighborhood_code")
    loc = loc.select(
        "location_id",
        F.coalesce(_lookup(config.LOCATION_CITY_NAMES, cc), F.upper(F.replace(cc, F.lit("_"), F.lit(" ")))).alias("city_name"),
        "city_code",
        F.coalesce(_lookup(config.LOCATION_NEIGHBORHOOD_NAMES, nc),
                   F.upper(F.replace(nc, F.lit("_"), F.lit(" ")))).alias("neighborhood_name"),
        "neighborhood_code",
        F.when(cc.isin(*config.LOCATION_RS_CITIES), "RS").otherwise("SC").alias("state_code"),
        F.lit("BR").alias("country_code"),
        F.lit(None).cast("decimal(9,6)").alias("latitude"),
        F.lit(None).cast("decimal(9,6)").alias("longitude"),
    )
    loc = small_key(loc, ["location_id"], "location_key")
    return loc.select("location_key", "location_id", "city_name", "city_code", "neighborhood_name",
                      "neighborhood_code", "state_code", "country_code", "latitude", "longitude")


# ---------------------------------------------------------------- M-10
def dim_store_location(tru: DataFrame, dim_store_df: DataFrame, dim_location_df: DataFrame,
                       seed: DataFrame | None = None) -> DataFrame:
    """Store x location bridge; hub id and sales channel filled from the region config."""
    pairs = (tru.where(F.col("supermarket").isNotNull() & F.col("region").isNotNull())
                .select(F.col("supermarket").alias("store_id"), F.col("region").alias("region_code"))
                .distinct())
    s = F.broadcast(dim_store_df.select("store_id", "store_key"))  # seed: 5 rows
    loc = dim_location_df.select(F.col("location_id").alias("region_code"), "location_key",
                                 "city_name", "neighborhood_name")
    j = pairs.join(s, "store_id").join(loc, "region_code")
    if seed is not None:
        j = j.join(F.broadcast(seed.select(F.col("store").alias("store_id"), "region_code", "hub_id",
                                           "sc_code")), ["store_id", "region_code"], "left")
    else:
        j = j.withColumn("hub_id", F.lit(None).cast("string")).withColumn("sc_code", F.lit(None).cast("string"))
    j = small_key(j, ["store_key", "location_key"], "store_location_key")
    return j.select(
        "store_location_key", "store_key", "location_key", "store_id",
        F.col("region_code").alias("location_id"), "city_name", "neighborhood_name",
        F.lit(None).cast("string").alias("store_address"), "hub_id", "sc_code",
        F.lit(True).alias("is_active"),
        F.lit(None).cast("date").alias("opened_at"), F.lit(None).cast("date").alias("closed_at"),
    )


# ---------------------------------------------------------------- M-11
def dim_ean(tru: DataFrame, ref_stg: DataFrame) -> DataFrame:
    """Distinct barcodes of the products, enriched with the latest reference record."""
    eans = (tru.where(F.col("eans").isNotNull() & (F.size("eans") > 0))
               .select(F.explode("eans").alias("ean_code")).distinct())
    ref = latest_per_key(ref_stg, ["ean_code"], ["scraped_at", "run_id"],
                         keep=["product_name", "brands", "categories", "quantity", "countries",
                               "nutriscore_grade"])
    g = F.col("nutriscore_grade")
    j = eans.join(ref.withColumn("_hit", F.lit(True)), "ean_code", "left")
    j = j.select(
        "ean_code",
        F.coalesce("product_name", F.lit("Unknown")).alias("canonical_name"),
        F.coalesce("brands", F.lit("Unknown")).alias("canonical_brand"),
        "categories",
        F.col("quantity").alias("net_weight"),
        F.col("countries").alias("country_of_origin"),
        "nutriscore_grade",
        F.when(g.isin("a", "b"), "Excellent").when(g == "c", "Good").when(g == "d", "Fair")
         .when(g == "e", "Poor").otherwise("Unknown").alias("nutrition_quality"),
        F.coalesce("_hit", F.lit(False)).alias("is_enriched"),
    )
    return sequential_key(j, ["ean_code"], "ean_key").select(
        "ean_key", "ean_code", "canonical_name", "canonical_brand", "categories", "net_weight",
        "country_of_origin", "nutriscore_grade", "nutrition_quality", "is_enriched")
