"""Registered queries: landed files and sinks (SRC-01..04, 06, 07, SNK-*),
incremental strategies (INC-*), enrichment (ENR-*, SRC-08..10), streaming (STR-*)
and the bronze hot-deal quality report (Q-00)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions import validate as V
from ..operators.dedup import latest_per_key
from ..plans import enrichment as E
from ..plans import incremental as I
from ..plans.history import ATTRS as SNAP_ATTRS, KEY as SNAP_KEY, WATCHED, with_rescrapes
from ..plans.dims import region_seed
from ..plans.staging import stg_products
from ..plans.trusted import GRAIN, record_rollup
from ..plans.warehouse import warehouse
from ..sinks import writers as W
from ..sinks.published import Published
from ..sources import adapter
from ..sources import bronze as B
from ..streaming import jobs as J
from . import q_history, q_ops, q_pages, q_reports  # noqa: F401  (register shared CTEs)
from .oracle import register as cte, with_ctes
from .registry import register

AS_OF = config.DEFAULT_AS_OF


def _wh(spark, sf):
    return warehouse(spark, sf)


PART_COUNTS = """SELECT supermarket, region, year(scraped_at) AS year, month(scraped_at) AS month,
       day(scraped_at) AS day, count(*) AS records,
       CAST(sum(CASE WHEN line_number % 2 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS skus
FROM obs {where} GROUP BY supermarket, region, year(scraped_at), month(scraped_at), day(scraped_at)"""


def _part_counts(df):
    return df.groupBy("supermarket", "region", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.size("items")).cast("bigint").alias("skus"))


@register("SNK-01", with_ctes(["obs"], PART_COUNTS.format(where="")))
def snk01(spark, sf):
    """Bronze landed as Hive-partitioned Parquet with lineage columns, read back."""
    w = _wh(spark, sf)
    return _part_counts(spark.read.parquet(w.landed()))


REPORT_SQL = {
    "R-01": "SELECT supermarket FROM snapshot GROUP BY supermarket",
    "R-05": "SELECT supermarket FROM snapshot GROUP BY supermarket",
    "R-06": f"SELECT 1 FROM silver_products WHERE collected_at >= TIMESTAMP '{(AS_OF - dt.timedelta(days=7)).isoformat()}' "
            "GROUP BY supermarket, CAST(collected_at AS DATE), region",
    "R-07": "SELECT supermarket FROM silver_products GROUP BY supermarket",
}

RUN_AT = dt.datetime.combine(AS_OF, dt.time(6))


@register("SNK-01b", with_ctes(["obs"], f"""
SELECT supermarket AS _metadata_supermarket, supermarket || '_load' AS _metadata_run_id,
       TIMESTAMP '{RUN_AT.isoformat(sep=' ')}' AS _metadata_scraped_at, count(*) AS records
FROM obs GROUP BY supermarket"""))
def snk01b(spark, sf):
    """Batches without lineage, one load per configured store: the load's metadata is added as it is written."""
    w = _wh(spark, sf)
    raw = w.bronze().drop(*[c for c in w.bronze().columns if c.startswith("_metadata_")])
    out = w.path("loads")
    for store in config.ADAPTER_STORES:
        rows = W.inject_metadata(raw.where(F.col("supermarket") == store),
                                 {"supermarket": store, "run_id": f"{store}_load", "scraped_at": RUN_AT})
        W.write_partitioned(rows, out, ("supermarket",), mode="append")
    return spark.read.parquet(out).groupBy("_metadata_supermarket", "_metadata_run_id", "_metadata_scraped_at").agg(
        F.count(F.lit(1)).alias("records"))


ROUTED = {"fct_promotion_summary": "pricing_marts", "fct_product_availability": "ops_marts"}


@register("SNK-05", with_ctes(["fct_promotion_summary", "fct_product_availability"], " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{s}' AS prod_schema, 'ana_{s}' AS dev_schema, count(*) AS prod_rows, "
    f"count(*) FILTER (WHERE region <> 'poa_nilo') AS dev_rows, "
    f"count(*) FILTER (WHERE region = 'poa_nilo') AS only_in_prod, 0 AS only_in_dev FROM {m}" for m, s in ROUTED.items())))
def snk05(spark, sf):
    """One model graph built for two targets: a developer's build (without one region, as under
    development) goes to a schema of its own and leaves the production tables as they are."""
    w = _wh(spark, sf)
    models = {m: (s, w.fact(m)) for m, s in ROUTED.items()}
    base = w.path("targets")
    prod, dev = W.Target(spark, base, "prod"), W.Target(spark, base, "dev", user="ana")
    prod.build(models)
    dev.build({m: (s, df.where("region <> 'poa_nilo'")) for m, (s, df) in models.items()})
    out = None
    for m, s in ROUTED.items():
        a, b = prod.read(s, m), dev.read(s, m)
        count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name), F.lit(m).alias("model"))
        row = count(a, "prod_rows")
        for other in (count(b, "dev_rows"), count(a.exceptAll(b), "only_in_prod"), count(b.exceptAll(a), "only_in_dev")):
            row = row.join(other, "model")
        row = row.withColumn("prod_schema", F.lit(W.schema_for("prod", s))).withColumn("dev_schema", F.lit(W.schema_for("dev", s, "ana")))
        out = row if out is None else out.unionByName(row)
    return out.select("model", "prod_schema", "dev_schema", "prod_rows", "dev_rows", "only_in_prod", "only_in_dev")


_QUALITY = """
, d AS (SELECT supermarket AS store, price, list_price, (list_price - price) / nullif(list_price, 0) * 100 AS pct FROM silver_products),
h AS (SELECT * FROM d WHERE pct >= 20),
s AS (SELECT store, count(*) AS count, CAST(round(CAST(sum(CAST(round(pct * 1000000) AS BIGINT))::DOUBLE / count(*) / 1e6 AS DECIMAL(38,6)), 1) AS DOUBLE) AS av,
             CAST(round(CAST(max(pct) AS DECIMAL(38,6)), 1) AS DOUBLE) AS mx FROM h GROUP BY store),
p AS (SELECT count(*) AS n FROM d WHERE price IS NOT NULL AND list_price IS NOT NULL)"""


def _r4(x):
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), 4) AS DOUBLE)"


@register("SNK-08", with_ctes(["silver_products"], _QUALITY + f"""
SELECT '{RUN_AT.isoformat()}' AS generated_at, 20.0 AS min_discount, 70.0 AS max_allowed, (SELECT count(*) FROM d) AS total_products,
       (SELECT n FROM p) AS products_with_pricing, (SELECT count(*) FROM h) AS total_hot_deals,
       {_r4("(SELECT count(*) FROM h) / (SELECT n FROM p) * 100")} AS hot_deals_percentage,
       {_r4("(SELECT sum(CAST(round(pct * 1000000) AS BIGINT))::DOUBLE / count(*) / 1e6 FROM h)")} AS average_discount,
       {_r4("(SELECT median(pct) FROM h)")} AS median_discount, {_r4("(SELECT max(pct) FROM h)")} AS max_discount,
       (SELECT count(*) FROM d WHERE price > list_price) AS invalid_pricing_count, (SELECT count(*) FROM d WHERE pct > 70) AS suspicious_deals_count,
       store, count AS deals, av AS avg_discount, mx AS store_max_discount FROM s"""))
def snk08(spark, sf):
    """The hot-deal quality report as JSON (parameters, summary, quality, by_store), read back."""
    from ..plans.quality_report import json_report
    w = _wh(spark, sf)
    p = W.write_json_report(json_report(w.silver(), RUN_AT), w.path("quality_report"))
    r = spark.read.schema(json_report(w.silver(), RUN_AT).schema).json(p).withColumn("s", F.explode("by_store"))
    return r.select("generated_at", "parameters.min_discount", F.col("parameters.max_discount").alias("max_allowed"), "summary.*", "quality.*",
                    "s.store", F.col("s.count").alias("deals"), "s.avg_discount", F.col("s.max_discount").alias("store_max_discount"))


@register("SNK-10", with_ctes(["snapshot"], " UNION ALL ".join(
    f"SELECT TIMESTAMP '{RUN_AT.isoformat(sep=' ')}' AS last_pipeline_run, 'completed' AS status, '1.0' AS version, "
    f"'{k}' AS output, (SELECT count(*) FROM ({v})) AS rows" for k, v in REPORT_SQL.items() if k != "R-06")))
def snk10(spark, sf):
    """A run's reports and its freshness marker, visible in one step. The next day's run fails in
    one report, so the marker and all reports stay those of the first."""
    from ..plans import reports as R
    w = _wh(spark, sf)
    s = w.silver()
    snap = R.build_snapshot(s, AS_OF)
    reports = {"R-01": R.r01_scorecard(snap), "R-05": R.r05_price_bands(snap), "R-07": R.r07_stats(s)}
    state = Published(spark, w.path("published_run"))
    W.publish_run(state, reports, RUN_AT, "1.0")
    broken = s.select(F.assert_true(F.col("price") < 0, "no such price").alias("x"), "supermarket")
    try:
        W.publish_run(state, {**reports, "R-09": broken}, RUN_AT + dt.timedelta(days=1), "1.1")
    except Exception as e:  # noqa: BLE001 - the failing report is the point
        if "no such price" not in str(e):
            raise
    return W.read_marker(state)


@register("SRC-01", with_ctes(["obs"], """
SELECT supermarket, region, count(*) AS records FROM obs WHERE supermarket IN ('bistek', 'fort')
GROUP BY supermarket, region"""))
def src01(spark, sf):
    """Partitioned scan with a partition filter on the store (union by name across files)."""
    df = B.read_bronze(spark, _wh(spark, sf).landed(), stores=["bistek", "fort"])
    return stg_products(df).groupBy("supermarket", "region").agg(F.count(F.lit(1)).alias("records"))


@register("SRC-02", with_ctes(["obs"], PART_COUNTS.format(
    where=f"WHERE supermarket <> 'carrefour' OR CAST(scraped_at AS DATE) < DATE '{AS_OF.isoformat()}'")))
def src02(spark, sf):
    """In-flight exclusion: today's partitions of a still-loading store are skipped."""
    df = B.exclude_in_flight(B.read_bronze(spark, _wh(spark, sf).landed()), "carrefour", AS_OF)
    return _part_counts(df)


@register("SNK-02", with_ctes(["obs"], PART_COUNTS.format(where="")))
def snk02(spark, sf):
    """Small batch files (several per store) compacted to one file per store partition."""
    w = _wh(spark, sf)
    batches = w.path("batches")
    # every split of the input is a batch, with a file of its own per store
    w.bronze().write.mode("overwrite").option("compression", "zstd").partitionBy("supermarket").parquet(batches)
    out = W.consolidate(spark, batches, w.path("compacted"), partition_cols=("supermarket",))
    return _part_counts(spark.read.parquet(out))


@register("SNK-03", with_ctes(["silver_products"], "SELECT * FROM silver_products"))
def snk03(spark, sf):
    w = _wh(spark, sf)
    p = W.export_zstd(w.silver(), w.path("silver_zstd"))
    return spark.read.parquet(p)


@register("SNK-06", with_ctes(["rechecks"], """
SELECT run_id, status, count(*) AS deals FROM (SELECT 'run_1' AS run_id, * FROM rechecks UNION ALL
                                                SELECT 'run_2', * FROM rechecks) GROUP BY run_id, status"""))
def snk06(spark, sf):
    """Validation results appended run after run to one table."""
    from ..plans import deal_checks as DC
    from ..sources import pages as P
    w = _wh(spark, sf)
    deals = DC.select_deals(w.fact("fct_hot_deals_validated"), w.tru(), AS_OF, min_discount=30)
    res = DC.recheck(deals, P.live_prices(adapter.product_pages(spark, sf)))
    p = w.path("validation_results")
    for run in ("run_1", "run_2"):
        W.append(res.withColumn("run_id", F.lit(run)), p)
    return spark.read.parquet(p).groupBy("run_id", "status").agg(F.count(F.lit(1)).alias("deals"))


@register("SNK-07", with_ctes(["rechecks"], """
SELECT product_id, supermarket, region, status FROM rechecks"""))
def snk07(spark, sf):
    """CSV output with a header, read back as text."""
    from ..plans import deal_checks as DC
    from ..sources import pages as P
    w = _wh(spark, sf)
    deals = DC.select_deals(w.fact("fct_hot_deals_validated"), w.tru(), AS_OF, min_discount=30)
    res = DC.recheck(deals, P.live_prices(adapter.product_pages(spark, sf)))
    p = W.write_csv(res.select("product_id", "supermarket", "region", "status"), w.path("csv"))
    return spark.read.option("header", True).csv(p)


@register("SNK-09", with_ctes(["snapshot"], " UNION ALL ".join(
    f"SELECT '{k}' AS report, (SELECT count(*) FROM ({v})) AS rows, "
    f"CASE WHEN (SELECT count(*) FROM ({v})) > 0 THEN 'written' ELSE 'empty' END AS status"
    for k, v in REPORT_SQL.items())))
def snk09(spark, sf):
    """Report bundle: one directory per result set; empty ones flagged, failures isolated."""
    from ..plans import reports as R
    w = _wh(spark, sf)
    s = w.silver()
    snap = R.build_snapshot(s, AS_OF)
    reports = {"R-01": R.r01_scorecard(snap), "R-05": R.r05_price_bands(snap),
               "R-06": R.r06_volume_audit(s, AS_OF), "R-07": R.r07_stats(s)}
    return W.write_bundle(spark, reports, w.path("bundle"))


JSON_SCHEMA = T.StructType([
    T.StructField("productId", T.StringType()), T.StructField("productName", T.StringType()),
    T.StructField("brand", T.StringType()), T.StructField("link", T.StringType()),
    T.StructField("_metadata_supermarket", T.StringType()), T.StructField("_metadata_region", T.StringType()),
    T.StructField("_metadata_scraped_at", T.StringType()),
])


def _land_json(w, name, partition=True):
    p = w.path(name)
    df = w.bronze().select("productId", "productName", "brand", "link", "_metadata_supermarket", "_metadata_region",
                           "_metadata_scraped_at", F.col("_metadata_supermarket").alias("supermarket"))
    (df.hint("rebalance", "supermarket").write.mode("overwrite").partitionBy("supermarket").json(p) if partition
     else df.drop("supermarket").write.mode("overwrite").json(p))
    return p


@register("SRC-03", with_ctes(["obs"], "SELECT supermarket, count(*) AS records FROM obs GROUP BY supermarket"))
def src03(spark, sf):
    """JSON lines with an explicit schema; the store is recovered from the file path."""
    w = _wh(spark, sf)
    df = B.read_jsonl(spark, _land_json(w, "jsonl") + "/*/*.json", JSON_SCHEMA)
    store = F.nullif(F.regexp_extract("filename", r"supermarket=([^/\\]+)", 1), F.lit(""))
    return df.groupBy(F.coalesce(store, F.lit("unknown")).alias("supermarket")).agg(F.count(F.lit(1)).alias("records"))


@register("SRC-04", with_ctes(["obs"], "SELECT supermarket, count(*) AS records FROM obs GROUP BY supermarket"))
def src04(spark, sf):
    """File discovery with fallback: no consolidated files exist, so the batch files are read."""
    w = _wh(spark, sf)
    df = B.discover_jsonl(spark, _land_json(w, "jsonl_batches"), JSON_SCHEMA)
    return df.groupBy(F.col("_metadata_supermarket").alias("supermarket")).agg(F.count(F.lit(1)).alias("records"))


@register("SRC-04b", with_ctes(["obs"], "SELECT supermarket, count(*) AS records FROM obs GROUP BY supermarket"))
def src04b(spark, sf):
    """File discovery where consolidated files exist: they alone are read, the batch files beside
    them would count every record twice."""
    w = _wh(spark, sf)
    base = w.path("jsonl_full")
    rows = w.bronze().select("productId", "productName", "brand", "link", "_metadata_supermarket", "_metadata_region", "_metadata_scraped_at")
    W.gzipped(rows).json(f"{base}/batches")
    W.write_full_jsonl(rows, f"{base}/full", gzip=True)
    df = B.discover_jsonl(spark, base, JSON_SCHEMA)
    return df.groupBy(F.col("_metadata_supermarket").alias("supermarket")).agg(F.count(F.lit(1)).alias("records"))


@register("SRC-06", with_ctes(["obs"], f"""
SELECT 'valid' AS state, count(*) * 2 AS records FROM obs
UNION ALL SELECT 'malformed', (SELECT count(*) FROM obs WHERE line_number = 7)
UNION ALL SELECT 'duplicate', count(*) * 2 - count(DISTINCT (product_id, strftime(scraped_at, '%Y-%m-%dT%H:%M:%S'))) FROM obs
UNION ALL SELECT 'landed', count(DISTINCT (product_id, strftime(scraped_at, '%Y-%m-%dT%H:%M:%S'))) FROM obs
  WHERE CAST(scraped_at AS DATE) BETWEEN DATE '2026-01-15' AND DATE '{AS_OF.isoformat()}'"""))
def src06(spark, sf):
    """Legacy JSON lines migration: the export was written twice (duplicates) and
    carries one malformed line per order line 7 record; counts per state plus the
    rows landed for the date range."""
    w = _wh(spark, sf)
    p = w.path("legacy")
    base = w.bronze().select("productId", "productName", "brand", "link", "_metadata_supermarket",
                             "_metadata_region", "_metadata_scraped_at", "_metadata_run_id",
                             F.element_at(F.split(F.get(F.col("items"), 0)["itemId"], "-"), 2).alias("_line"))
    good = base.drop("_line").select(F.to_json(F.struct("*")).alias("value"))
    bad = base.where(F.col("_line") == "7").select(F.concat(F.lit('{"productId": "'), F.col("productId"),
                                                              F.lit('", broken')).alias("value"))
    W.gzipped(good.unionByName(good).unionByName(bad)).mode("overwrite").text(p)
    landed, counts = B.migrate_legacy(spark, p, B.with_field(JSON_SCHEMA, "_metadata_run_id", T.StringType()),
                                      dt.date(2026, 1, 15), AS_OF)
    return counts.where("state <> 'invalid' OR records > 0").unionByName(
        landed.agg(F.lit("landed").alias("state"), F.count(F.lit(1)).alias("records")))


@register("SRC-07", with_ctes(["obs"], """
SELECT supermarket AS _metadata_supermarket, region AS _metadata_region, count(*) AS records,
       count(*) AS backfilled_run_ids FROM obs GROUP BY supermarket, region"""))
def src07(spark, sf):
    """Files written without lineage columns get them back from the path."""
    w = _wh(spark, sf)
    p = w.path("no_metadata")
    (w.bronze().select("productId", "productName", "supermarket", "region")
       .hint("rebalance", "supermarket", "region").write.mode("overwrite").partitionBy("supermarket", "region").parquet(p))
    df = B.backfill_metadata(spark.read.parquet(p))
    return df.groupBy("_metadata_supermarket", "_metadata_region").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("_metadata_run_id").startswith("backfill_"))
        .alias("backfilled_run_ids"))


# ------------------------------------------------------------------ enrichment
cte("eans_wanted", """
eans_wanted AS (SELECT DISTINCT unnest(eans) AS code FROM tru WHERE eans IS NOT NULL)
""".strip(), ["tru"])

cte("bulk_ref", """
bulk_ref AS (
  SELECT code, trim(product_name) AS product_name, lower(nutriscore_grade) AS g, trim(brands) AS brands, run_id
  FROM refraw
)""", ["refraw"])


def _codes(w):
    return E.unique_barcodes(w.tru())


def _bulk_records(w):
    r = adapter.reference_products(w.spark, w.sf_dir)
    return r.select("code", F.array(F.struct(F.lit("pt").alias("lang"), F.trim("product_name").alias("text")))
                    .alias("product_name"), "brands", "categories", "quantity", "countries", "nutriscore_grade",
                    "image_url", F.col("_metadata_run_id").alias("_run"))


@register("ENR-01", with_ctes(["tru"], """
SELECT DISTINCT unnest(eans) AS code FROM tru WHERE eans IS NOT NULL"""))
def enr01(spark, sf):
    return _codes(_wh(spark, sf))


_SRC08 = """SELECT b.code, b.product_name,
       CASE WHEN b.g IN ('a','b','c','d','e') THEN b.g END AS nutriscore_grade
FROM bulk_ref b WHERE length(b.code) IN (8, 13, 14) AND b.code IN (SELECT code FROM eans_wanted)"""


@register("SRC-08", with_ctes(["bulk_ref", "eans_wanted"], _SRC08))
def src08(spark, sf):
    w = _wh(spark, sf)
    p = w.path("bulk_parquet")
    _bulk_records(w).write.mode("overwrite").parquet(p)
    return B.read_barcode_parquet(spark, p, _codes(w)).select("code", "product_name", "nutriscore_grade")


@register("SRC-09", with_ctes(["bulk_ref", "eans_wanted"], _SRC08))
def src09(spark, sf):
    w = _wh(spark, sf)
    p = w.path("bulk_tsv")
    (_bulk_records(w).select("code", F.get(F.col("product_name"), 0)["text"].alias("product_name"), "brands",
                             "categories", "quantity", "countries", "nutriscore_grade", "image_url")
       .write.mode("overwrite").option("sep", "\t").option("header", True).option("compression", "gzip").csv(p))
    return B.read_barcode_tsv(spark, p, _codes(w)).select("code", "product_name", "nutriscore_grade")


@register("ENR-02", with_ctes(["eans_wanted", "refraw"], """
SELECT code AS ean, 1 AS requested_in FROM refraw WHERE run_id = 'ref_2026_01' GROUP BY code
UNION ALL
SELECT code, 2 FROM eans_wanted WHERE code NOT IN (SELECT code FROM refraw WHERE run_id = 'ref_2026_01')"""))
def enr02(spark, sf):
    """The watermark of requested barcodes, written by a run and read back by the next: the
    first run requests the older import's barcodes, the second the products' new ones, the
    third finds none and leaves the watermark as it is."""
    w = _wh(spark, sf)
    state = Published(spark, w.path("requested"))
    first = adapter.reference_products(spark, sf).where(F.col("_metadata_run_id") == "ref_2026_01").select("code")
    E.request_new(state, first)
    E.request_new(state, _codes(w))
    E.request_new(state, _codes(w))
    return E.requested_barcodes(state)


@register("ENR-03", with_ctes(["bulk_ref", "eans_wanted"], f"""
, f AS ({_SRC08})
SELECT (SELECT count(*) FROM eans_wanted) AS requested, (SELECT count(DISTINCT code) FROM f) AS found,
       (SELECT count(*) FROM eans_wanted) - (SELECT count(DISTINCT code) FROM f) AS missing,
       CAST(round(CAST((SELECT count(DISTINCT code) FROM f) / (SELECT count(*) FROM eans_wanted) * 100 AS DECIMAL(38,6)), 2)
         AS DOUBLE) AS success_rate_pct"""))
def enr03(spark, sf):
    """Bulk import: read the bulk file, keep wanted valid codes, land them, report coverage (ENR-05)."""
    w = _wh(spark, sf)
    p = w.path("bulk_parquet_import")
    _bulk_records(w).write.mode("overwrite").parquet(p)
    codes = _codes(w)
    found = B.read_barcode_parquet(spark, p, codes)
    out = w.path("reference_bronze")
    V.normalize_reference(found).write.mode("overwrite").parquet(out)
    return E.enrichment_stats(codes, spark.read.parquet(out))


@register("ENR-05", with_ctes(["stg_ref", "eans_wanted"], """
, f AS (SELECT DISTINCT ean_code AS code FROM stg_ref WHERE ean_code IN (SELECT code FROM eans_wanted))
SELECT (SELECT count(*) FROM eans_wanted) AS requested, (SELECT count(*) FROM f) AS found,
       (SELECT count(*) FROM eans_wanted) - (SELECT count(*) FROM f) AS missing,
       CAST(round(CAST((SELECT count(*) FROM f) / (SELECT count(*) FROM eans_wanted) * 100 AS DECIMAL(38,6)), 2) AS DOUBLE)
         AS success_rate_pct"""))
def enr05(spark, sf):
    w = _wh(spark, sf)
    return E.enrichment_stats(_codes(w), w.reference().select(F.col("ean_code").alias("code")))


cte("delta_records", """
delta_records AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 13, '0') AS code,
         CASE WHEN p_partkey % 4 = 2 THEN p_name WHEN p_partkey % 5 = 0 THEN NULL ELSE 'new ' || p_name END AS product_name,
         p_brand AS brands,
         CASE WHEN p_partkey % 4 <> 2 THEN 'a' WHEN p_partkey % 6 = 0 THEN 'a' WHEN p_partkey % 6 = 2 THEN 'c'
              WHEN p_partkey % 6 = 4 THEN 'e' END AS nutriscore_grade,
         (p_partkey // 3) % 3 AS file,
         CAST(1700000000 + ((p_partkey // 3) % 3) * 1000 + p_partkey % 100 AS BIGINT) AS last_modified_t
  FROM part WHERE lpad(CAST(p_partkey AS VARCHAR), 13, '0') IN (SELECT code FROM eans_wanted)
)""", ["eans_wanted"])

OLD_DELTA = adapter.DELTA_RANGES[0][1]


@register("SRC-10", with_ctes(["delta_records"], """
SELECT code, product_name, last_modified_t FROM delta_records WHERE file <> 0"""))
def src10(spark, sf):
    """Delta files: the first one ends at the watermark and isn't read, though it holds wanted
    barcodes too; names as list or text, 'unknown' -> NULL."""
    w = _wh(spark, sf)
    recs, _, _ = B.read_barcode_deltas(spark, adapter.land_deltas(spark, sf, w.path("deltas")), OLD_DELTA, _codes(w))
    return recs.select("code", "product_name", "last_modified_t")


def _synced(spark, sf):
    """A state after the bulk import, a synchronisation, a refresh and a second synchronisation."""
    w = _wh(spark, sf)
    codes = _codes(w)
    state = Published(spark, w.path("reference_state"))
    bulk = _bulk_records(w).select("code", F.get("product_name", 0)["text"].alias("product_name"), F.trim("brands").alias("brands"),
                                   F.lower("nutriscore_grade").alias("nutriscore_grade"), "_run")
    bulk = latest_per_key(bulk, ["code"], ["_run"], keep=["product_name", "brands", "nutriscore_grade"])
    E.import_reference(state, V.normalize_reference(bulk.where(V.reference_rules()["VAL-09 code"])), OLD_DELTA)
    deltas = adapter.land_deltas(spark, sf, w.path("deltas"))
    log = [E.delta_sync(state, deltas, codes)]
    E.refresh_if_changed(state, "names", lambda r: r.groupBy("nutriscore_grade").agg(F.count("product_name").alias("names")))
    log.append(E.delta_sync(state, deltas, codes))
    return state, log


_ENR04 = """
, imported AS (
  SELECT code, product_name, brands, CASE WHEN g IN ('a','b','c','d','e') THEN g END AS nutriscore_grade FROM bulk_ref
  WHERE length(code) IN (8, 13, 14) QUALIFY row_number() OVER (PARTITION BY code ORDER BY run_id DESC) = 1),
changed AS (
  SELECT d.* FROM delta_records d LEFT JOIN imported i ON i.code = d.code
  WHERE d.file <> 0 AND (i.code IS NULL OR d.product_name IS DISTINCT FROM i.product_name
                         OR d.brands IS DISTINCT FROM i.brands OR d.nutriscore_grade IS DISTINCT FROM i.nutriscore_grade)),
synced AS (
  SELECT code, product_name, brands, nutriscore_grade, CAST(1700000000 + file * 1000 + 999 AS BIGINT) AS as_of_delta FROM changed
  UNION ALL
  SELECT code, product_name, brands, nutriscore_grade, CAST(1700000999 AS BIGINT) FROM imported
  WHERE code NOT IN (SELECT code FROM changed))"""


@register("ENR-04", with_ctes(["bulk_ref", "delta_records"], _ENR04 + "\nSELECT * FROM synced"))
def enr04(spark, sf):
    """Delta synchronisation: imported records, those that the new deltas changed replaced."""
    return E.latest_reference(_synced(spark, sf)[0])


@register("ENR-04b", with_ctes(["bulk_ref", "delta_records"], _ENR04 + """
SELECT 1 AS run, 2 AS files, (SELECT count(*) FROM changed) AS changed, 0 AS malformed, 1700002999 AS last_timestamp,
       (SELECT count(*) > 0 FROM changed) AS refresh
UNION ALL SELECT 2, 0, 0, 0, 1700002999, false"""))
def enr04b(spark, sf):
    """What the two synchronisations report: the second finds no new file and asks for no refresh."""
    _, log = _synced(spark, sf)
    cols = ["files", "changed", "malformed", "last_timestamp", "refresh"]
    return spark.createDataFrame([(i + 1, *[r[c] for c in cols]) for i, r in enumerate(log)],
                                 "run long, files long, changed long, malformed long, last_timestamp long, refresh boolean")


# ------------------------------------------------------------------ incremental
CUT = AS_OF - dt.timedelta(days=7)
TRU_COLS = ["product_id", "supermarket", "region", "scraped_date", "scraped_at", "min_price", "run_id"]
_TC = ", ".join(TRU_COLS)


@register("INC-01", with_ctes(["tru"], f"""
SELECT {_TC} FROM tru WHERE scraped_at > (SELECT max(scraped_at) FROM tru WHERE scraped_date < DATE '{CUT.isoformat()}')"""))
def inc01(spark, sf):
    t = _wh(spark, sf).tru().select(*TRU_COLS)
    return I.new_since_watermark(t, t.where(F.col("scraped_date") < F.lit(CUT)))


@register("INC-02", with_ctes(["tru"], f"SELECT {_TC} FROM tru"))
def inc02(spark, sf):
    t = _wh(spark, sf).tru().select(*TRU_COLS)
    return I.append_new_days(t.where(F.col("scraped_date") < F.lit(CUT)), t.where(F.col("scraped_date") >= F.lit(CUT - dt.timedelta(days=3))))


@register("INC-03", with_ctes(["tru"], f"""
SELECT product_id, supermarket, region, scraped_date, scraped_at,
       CASE WHEN scraped_date >= DATE '{(CUT - dt.timedelta(days=3)).isoformat()}' THEN min_price * 2 ELSE min_price END
         AS min_price, run_id
FROM tru"""))
def inc03(spark, sf):
    """Upsert by the full grain: the source re-delivers the last 10 days with new prices."""
    t = _wh(spark, sf).tru().select(*TRU_COLS)
    src = t.where(F.col("scraped_date") >= F.lit(CUT - dt.timedelta(days=3))).withColumn("min_price", F.col("min_price") * 2)
    return I.merge_upsert(t.where(F.col("scraped_date") < F.lit(CUT)).unionByName(
        t.where(F.col("scraped_date") >= F.lit(CUT))), src, GRAIN, update_columns=["min_price"])


@register("INC-04", with_ctes(["tru"], f"SELECT {_TC} FROM tru"))
def inc04(spark, sf):
    """insert_overwrite by day with a 3-day lookback (INC-05): rerunning is idempotent."""
    w = _wh(spark, sf)
    t = w.tru().select(*TRU_COLS)
    return I.run_incremental(spark, t, w.path("inc_target"), CUT, lookback_days=3).select(*TRU_COLS)


@register("INC-05", with_ctes(["tru"], f"""
SELECT {_TC} FROM tru WHERE scraped_date >= (SELECT max(scraped_date) FROM tru WHERE scraped_date < DATE '{CUT.isoformat()}') - INTERVAL 3 DAY"""))
def inc05(spark, sf):
    t = _wh(spark, sf).tru().select(*TRU_COLS)
    return I.lookback_window(t, t.where(F.col("scraped_date") < F.lit(CUT)), 3)


EVOLVING = [*TRU_COLS, "sku_count"]
_EV = ", ".join(EVOLVING)
_OLD, _NEW = f"scraped_date < DATE '{CUT.isoformat()}'", f"scraped_date >= DATE '{CUT.isoformat()}'"


def _evolving(spark, sf):
    """A table of the days before the cut, and the later days as a batch with a new column, one
    missing and one of a narrower type."""
    w = _wh(spark, sf)
    t = w.tru().withColumn("price_range", F.col("max_price") - F.col("min_price"))
    table = I.EvolvingTable(spark, w.path("evolving"), "scraped_date")
    table.append(t.where(F.col("scraped_date") < F.lit(CUT)).select(*EVOLVING))
    later = t.where(F.col("scraped_date") >= F.lit(CUT))
    batch = later.select(*[c for c in EVOLVING if c not in ("run_id", "sku_count")], F.col("sku_count").cast("int").alias("sku_count"),
                         "price_range")
    return table, batch, later


@register("INC-06", with_ctes(["tru"], f"""
SELECT {_EV.replace("run_id", f"CASE WHEN {_OLD} THEN run_id END AS run_id")},
       CASE WHEN {_NEW} THEN max_price - min_price END AS price_range FROM tru"""))
def inc06(spark, sf):
    """on_schema_change = append_new_columns: price_range is added, run_id is NULL where the
    batch lacks it, sku_count keeps the wider type."""
    table, batch, _ = _evolving(spark, sf)
    table.append(batch, "append_new_columns")
    return table.read()


@register("INC-06b", with_ctes(["tru"], f"""
SELECT {_EV}, 'added price_range; removed run_id; changed sku_count bigint to int' AS refused FROM tru WHERE {_OLD}"""))
def inc06b(spark, sf):
    """on_schema_change = fail: the batch is refused, the table is what it was."""
    table, batch, _ = _evolving(spark, sf)
    try:
        table.append(batch, "fail")
        refused = ""
    except I.SchemaRefused as e:
        refused = str(e)
    return table.read().withColumn("refused", F.lit(refused))


@register("INC-06c", with_ctes(["tru"], f"SELECT {_EV}, true AS refused FROM tru"))
def inc06c(spark, sf):
    """on_schema_change = ignore: a batch that lacks run_id is refused; with it, its new column
    is left out and its narrower type widened."""
    table, batch, later = _evolving(spark, sf)
    try:
        table.append(batch, "ignore")
        refused = False
    except I.SchemaRefused:
        refused = True
    table.append(later.select(*TRU_COLS, F.col("sku_count").cast("int").alias("sku_count"), "price_range"), "ignore")
    return table.read().withColumn("refused", F.lit(refused))


@register("INC-06d", with_ctes(["tru"], f"""
SELECT {_EV.replace("run_id", "CAST(NULL AS VARCHAR) AS run_id").replace("sku_count", "CAST(sku_count AS INTEGER) AS sku_count")},
       CASE WHEN {_NEW} THEN max_price - min_price END AS price_range FROM tru
UNION ALL
SELECT {_EV.replace("sku_count", "CAST(sku_count AS INTEGER)")}, max_price - min_price FROM tru WHERE {_NEW}"""))
def inc06d(spark, sf):
    """on_schema_change = sync_all_columns: run_id goes with the first batch; when a second one
    brings it back, only that batch's rows have it, not the older partitions that stored it."""
    table, batch, later = _evolving(spark, sf)
    table.append(batch, "sync_all_columns")
    table.append(later.select(*TRU_COLS, F.col("sku_count").cast("int").alias("sku_count"), "price_range"), "sync_all_columns")
    return table.read()


@register("SRC-12", with_ctes(["obs", "region_seed"], """
SELECT coalesce(o.supermarket, r.store) AS store, coalesce(o.region, r.region_code) AS region_code, r.postal_code, r.sc_code, r.hub_id,
       r.store IS NOT NULL AS configured, coalesce(o.records, 0) AS records
FROM (SELECT supermarket, region, count(*) AS records FROM obs GROUP BY ALL) o
FULL JOIN region_seed r ON r.store = o.supermarket AND r.region_code = o.region"""))
def src12(spark, sf):
    """The stores' region configuration against what was collected, by store and region."""
    seen = _wh(spark, sf).stg().groupBy(F.col("supermarket").alias("store"), F.col("region").alias("region_code")).agg(
        F.count(F.lit(1)).alias("records"))
    seed = region_seed(spark).withColumn("configured", F.lit(True))
    return seen.join(seed, ["store", "region_code"], "full").select(
        "store", "region_code", "postal_code", "sc_code", "hub_id", F.coalesce("configured", F.lit(False)).alias("configured"),
        F.coalesce("records", F.lit(0)).alias("records"))


# ------------------------------------------------------------------ streaming
def _ckpt(w, name):
    return w.path(f"ckpt_{name}")


@register("STR-01", with_ctes(["obs"], """
SELECT supermarket, count(*) FILTER (WHERE ok) AS records, count(*) FILTER (WHERE NOT ok) AS rejected
FROM (SELECT supermarket, available_quantity >= 0 AND (line_number % 2 <> 0 OR floor(available_quantity / 2) >= 0) AS ok
      FROM obs) GROUP BY supermarket"""))
def str01(spark, sf):
    """Landed files -> validated bronze and a table of rejects, availableNow with checkpoints."""
    w = _wh(spark, sf)
    landing = w.landed()
    schema = spark.read.parquet(landing).schema
    valid, rejects = J.ingest_validated(spark, landing, schema, w.path("validated"), w.path("rejects"), _ckpt(w, "str01"))
    both = valid.select("supermarket", F.lit(1).alias("ok")).unionByName(rejects.select("supermarket", F.lit(0).alias("ok")))
    return both.groupBy("supermarket").agg(F.count_if(F.col("ok") == 1).alias("records"),
                                           F.count_if(F.col("ok") == 0).alias("rejected"))


@register("STR-02", with_ctes(["tru"], """
SELECT product_id, supermarket, region, scraped_date, scraped_at, run_id, min_price, max_price, sku_count FROM tru"""))
def str02(spark, sf):
    """Latest record per product x store x region x day from the landed stream, with the
    prices rolled up from the streamed record itself; a 3-day watermark closes days."""
    w = _wh(spark, sf)
    landing = w.landed()
    schema = spark.read.parquet(landing).schema
    s = spark.readStream.schema(schema).option("basePath", landing).parquet(landing)
    rows = record_rollup(stg_products(s)).select(*GRAIN, "scraped_at", "run_id", "_first_item", "min_price", "max_price",
                                                 "sku_count", "_has_items")
    out = J.upsert_latest(spark, rows, GRAIN, "scraped_at", w.path("latest"), _ckpt(w, "str02"), w.path("late"),
                          ties=["run_id", "_first_item"])
    return out.where("_has_items").select(*GRAIN, "scraped_at", "run_id", "min_price", "max_price", "sku_count")


@register("STR-03", with_ctes(["batches"], """
SELECT date_trunc('hour', started_at) AS window_start, date_trunc('hour', started_at) + INTERVAL 1 HOUR AS window_end,
       region, count(*) AS batches, count(*) FILTER (WHERE NOT success) AS errors,
       avg(response_time_ms) AS avg_response_time_ms
FROM batches GROUP BY date_trunc('hour', started_at), region"""))
def str03(spark, sf):
    """Batch-event monitoring: 1-hour tumbling windows per region."""
    w = _wh(spark, sf)
    src = w.path("events_landing")
    adapter.scraper_batches(spark, sf).drop("_view", "_signup").write.mode("overwrite").parquet(src)
    schema = spark.read.parquet(src).schema
    s = spark.readStream.schema(schema).parquet(src)
    from ..functions.columns import snap
    aggs = [F.count(F.lit(1)).alias("batches"), F.count_if(~F.col("success")).alias("errors"),
            F.avg("response_time_ms").alias("avg_response_time_ms")]
    return J.windowed_monitor(spark, s, "started_at", ["region"], aggs, w.path("monitor"), _ckpt(w, "str03"))


@register("STR-04", with_ctes(["obs"], """
SELECT date_trunc('hour', scraped_at) AS window_start, date_trunc('hour', scraped_at) + INTERVAL 1 HOUR AS window_end,
       supermarket, region, count(*) AS observations,
       count(*) FILTER (WHERE available_quantity <= 0) AS out_of_stock
FROM obs GROUP BY date_trunc('hour', scraped_at), supermarket, region"""))
def str04(spark, sf):
    """Hourly availability fact from the landed stream."""
    w = _wh(spark, sf)
    landing = w.landed()
    schema = spark.read.parquet(landing).schema
    s = spark.readStream.schema(schema).option("basePath", landing).parquet(landing)
    q = F.get(F.get(F.col("items"), 0)["sellers"], 0)["commertialOffer"]["AvailableQuantity"]
    rows = s.select(F.col("_metadata_scraped_at").cast("timestamp").alias("ts"), "supermarket", "region",
                    (q <= 0).alias("oos"))
    aggs = [F.count(F.lit(1)).alias("observations"), F.count_if("oos").alias("out_of_stock")]
    return J.windowed_monitor(spark, rows, "ts", ["supermarket", "region"], aggs, w.path("availability"),
                              _ckpt(w, "str04"), delay="1 day")


@register("STR-05", with_ctes(["snap_chk"], f"SELECT {q_history.OUT} FROM snap_chk"))
def str05(spark, sf):
    """Price-change feed: SCD-2 history merged per micro-batch (check strategy)."""
    w = _wh(spark, sf)
    src = w.path("tru_stream")
    # in the order of the trusted rows: a product's looks lie together and pack well
    with_rescrapes(w.tru()).select(*SNAP_KEY, *SNAP_ATTRS).write.mode("overwrite").option("compression", "zstd").parquet(src)
    s = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    h = J.price_change_feed(spark, s, SNAP_KEY, "scraped_at", SNAP_ATTRS, w.path("history"), _ckpt(w, "str05"),
                            check_cols=WATCHED, near=SNAP_KEY[:1])
    return h.select(*[c.strip() for c in q_history.OUT.split(",")])


# ------------------------------------------------------------------ Q-00
@register("Q-00", with_ctes(["silver_products"], f"""
, d AS (SELECT supermarket AS store, price, list_price, (list_price - price) / nullif(list_price, 0) * 100 AS d
        FROM silver_products WHERE price IS NOT NULL AND list_price IS NOT NULL),
h AS (SELECT * FROM d WHERE d >= 20)
SELECT 'invalid_price' AS section, NULL AS label, count(*) AS n, NULL::DOUBLE AS value FROM d WHERE price > list_price
UNION ALL SELECT 'no_discount', NULL, count(*), NULL FROM d WHERE price = list_price
UNION ALL SELECT 'histogram', b, count(*), NULL FROM (
    SELECT CASE WHEN d <= 30 THEN '20-30%' WHEN d <= 50 THEN '30-50%' WHEN d <= 70 THEN '50-70%' ELSE '70%+' END AS b
    FROM h) GROUP BY b
UNION ALL SELECT 'by_store', store, count(*), {"CAST(round(CAST(avg(d) AS DECIMAL(38,6)), 1) AS DOUBLE)"} FROM h GROUP BY store"""))
def q00(spark, sf):
    """Hot-deal quality report on the landed records."""
    from ..plans.quality_report import hot_deal_quality
    return hot_deal_quality(_wh(spark, sf).silver())


@register("SRT-04", with_ctes(["silver_products"], """
SELECT supermarket, sku, name, price, list_price, (list_price - price) / nullif(list_price, 0) * 100 AS discount_pct
FROM silver_products WHERE (list_price - price) / nullif(list_price, 0) * 100 > 70
ORDER BY discount_pct DESC, sku, supermarket, region, collected_at LIMIT 10"""))
def srt04(spark, sf):
    """Top-10 suspicious discounts of the bronze quality report (nlargest)."""
    from ..plans.quality_report import suspicious_top
    return suspicious_top(_wh(spark, sf).silver())
