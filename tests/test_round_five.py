"""Disk at scale: what is shuffled, written and broadcast."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from shelfscope.operators import scd
from shelfscope.plans import deal_checks as DC
from shelfscope.plans import trusted
from shelfscope.plans.staging import stg_products
from shelfscope.sinks import writers as W
from shelfscope.sources import adapter, bronze
from shelfscope.streaming import jobs as J

AT = dt.datetime(2026, 1, 1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _driver(spark, base, products=6):
    part = [(k, f"Great thing {k}", "Brand#1", "TYPE", 3, 10.0 + k) for k in range(products)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double") \
        .write.parquet(f"{base}/part.parquet")
    lines = [(o, (o + n) % products, o % 7, n, 5.0, 100.0 + n, 0.02 * n, dt.datetime(1995, 1, 1 + o % 20)) for o in range(40) for n in (1, 2, 3)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                 "l_extendedprice double, l_discount double, l_shipdate timestamp").write.parquet(f"{base}/lineitem.parquet")
    return str(base)


def test_trusted_rows_are_shuffled_once_while_narrow(spark, tmp_path):
    sf = _driver(spark, tmp_path)
    stg = stg_products(adapter.bronze_products(spark, sf))
    once, twice = trusted.tru_product(stg, laid=True), trusted.tru_product(stg)
    assert _plan(once).count("Exchange ") == 2          # lineitem and part, before the join
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_landed_rows_are_clustered_while_narrow(spark, tmp_path):
    sf = _driver(spark, tmp_path)
    rows = adapter.bronze_products(spark, sf, lambda df: df.hint("rebalance", *W.BRONZE_PARTITIONS))
    wide = adapter.bronze_products(spark, sf)
    assert rows.columns == wide.columns and rows.schema == wide.schema
    assert sorted(map(str, rows.collect())) == sorted(map(str, wide.collect()))
    plan = _plan(rows)
    assert plan.index("https://www.") < plan.index("REBALANCE")      # names and addresses are made above the shuffle


def test_growing_tables_are_never_broadcast_by_the_size_of_packed_files(spark, tmp_path):
    hot = [("1", "fort", "r", AT.date(), 5.0, 40.0), ("2", "fort", "r", AT.date(), 5.0, 40.0), (None, "fort", "r", AT.date(), 5.0, 40.0)]
    spark.createDataFrame(hot, "product_id string, supermarket string, region string, scraped_date date, promotional_price double, "
                               "discount_percentage double").write.parquet(f"{tmp_path}/hot")
    spark.createDataFrame([("1", "fort", "u1"), ("1", "fort", "u0")], "product_id string, supermarket string, product_url string") \
        .write.parquet(f"{tmp_path}/tru")
    live = [(1, "u0", 200, 5.0, 40.0), (2, "u0", 200, 1.0, 1.0)]
    spark.createDataFrame(live, "page_id long, url string, status int, live_price double, live_discount_pct double").write.parquet(f"{tmp_path}/live")
    read = lambda n: spark.read.parquet(f"{tmp_path}/{n}")
    checked = DC.recheck(DC.select_deals(read("hot"), read("tru"), AT.date()), read("live"))
    assert "BroadcastExchange" not in _plan(checked)
    assert sorted((str(r.product_id), str(r.product_url), r.status) for r in checked.collect()) == [
        ("1", "u0", "active"), ("2", "None", "no_url"), ("None", "None", "no_url")]


def test_gzipped_lines_are_bounded_and_found(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "GZIP_LINES", 10)
    rows = spark.range(25).select(F.col("id").cast("string").alias("productId")).coalesce(1)
    schema = rows.schema
    W.gzipped(rows).json(f"{tmp_path}/x/batches")
    assert len(glob.glob(f"{tmp_path}/x/batches/part-*.json.gz")) == 3
    assert bronze.discover_jsonl(spark, f"{tmp_path}/x", schema).count() == 25
    W.write_full_jsonl(rows, f"{tmp_path}/x/full", gzip=True)
    assert len(glob.glob(f"{tmp_path}/x/full/*_full.jsonl.gz")) == 3
    found = bronze.discover_jsonl(spark, f"{tmp_path}/x", schema)
    assert found.count() == 25 and found.where(~F.col("filename").contains("_full.jsonl")).count() == 0
    W.write_full_jsonl(rows, f"{tmp_path}/y/full")
    assert bronze.discover_jsonl(spark, f"{tmp_path}/y", schema).count() == 25


OBS = "k string, region string, price double, scraped_at timestamp"


def _obs(spark, rows):
    return spark.createDataFrame([(k, r, p, AT + dt.timedelta(days=d)) for k, r, p, d in rows], OBS)


def test_history_and_batch_of_one_plan_are_shuffled_once(spark):
    before = _obs(spark, [("a", "x", 1.0, 0), ("a", "x", 2.0, 1), ("b", "x", 1.0, 0), (None, "x", 1.0, 0)])
    batch = _obs(spark, [("a", "x", 2.0, 2), ("c", "y", 5.0, 2), (None, "x", 3.0, 2)])
    key, known = ["k", "region"], {"hard_deletes": "new_record", "as_of": AT + dt.timedelta(days=9)}
    merged = [scd.merge(scd.history_from_observations(before, key, "scraped_at", ["price", "scraped_at"], dealt=dealt), batch, key,
                        "scraped_at", ["price", "scraped_at"], dealt=dealt, **known) for dealt in (True, False)]
    assert _plan(merged[0]).count("Exchange ") == 2     # the history's rows and the batch's, each once
    assert sorted(map(str, merged[0].collect())) == sorted(map(str, merged[1].collect()))


def test_stored_history_leaves_out_what_follows_from_key_and_start(spark):
    key = ["k", "region"]
    h = scd.history_from_observations(_obs(spark, [("a", "x", 1.0, 0), ("a", "x", 2.0, 1)]), key, "scraped_at", ["price", "scraped_at"])
    h = h.unionByName(h.withColumn("scd_id", F.lit(None).cast("string"))).unionByName(
        h.withColumn("scd_id", F.lit("own")).withColumn("updated_at", F.lit(AT)))
    stored = scd.packed(h, key)
    assert stored.where(F.col("scd_id").isNull()).count() == 2
    back = scd.unpacked(stored, key)
    assert back.columns == h.columns and sorted(map(str, back.collect())) == sorted(map(str, h.collect()))


def test_a_products_keys_lie_in_one_bucket(spark, tmp_path):
    rows = [(f"p{i % 5}", f"r{i % 8}", float(i % 3), i % 6) for i in range(240)]
    obs = _obs(spark, rows).dropDuplicates(["k", "region", "scraped_at"])
    obs.where(F.col("scraped_at") < F.lit(AT + dt.timedelta(days=3))).coalesce(1).write.parquet(f"{tmp_path}/src")
    key, attrs = ["k", "region"], ["price", "scraped_at"]

    def feed():
        return J.price_change_feed(spark, spark.readStream.schema(OBS).parquet(f"{tmp_path}/src"), key, "scraped_at", attrs,
                                   f"{tmp_path}/h", f"{tmp_path}/ck", bucket_rows=20, near=["k"])
    feed()
    obs.where(F.col("scraped_at") >= F.lit(AT + dt.timedelta(days=3))).coalesce(1).write.mode("append").parquet(f"{tmp_path}/src")
    hist = feed()
    want = scd.history_from_observations(obs, key, "scraped_at", attrs, strategy="check")
    assert sorted(map(str, hist.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    homes = hist.withColumn("f", F.regexp_extract(F.input_file_name(), "_bucket=(b[01]*)", 1)).groupBy("k").agg(F.count_distinct("f").alias("n"))
    assert hist.select(F.input_file_name()).distinct().count() > 1 and {r.n for r in homes.collect()} == {1}


def test_late_records_are_found_from_their_keys(spark, tmp_path):
    schema = "k string, scraped_date date, scraped_at timestamp, run_id string, price double"
    day = lambda k, d, h, run, p: (k, (AT + dt.timedelta(days=d)).date(), AT + dt.timedelta(days=d, hours=h), run, p)
    files = [[day("a", 0, 1, "r1", 1.0), day(None, 0, 1, "r1", 7.0)], [day("b", 30, 1, "r1", 2.0)], [day("c", 31, 1, "r1", 2.5)],
             [day("a", 0, 5, "r2", 3.0), day("a", 0, 0, "r2", 4.0), day("z", 0, 2, "r2", 5.0)]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/src")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/src")
        out = J.upsert_latest(spark, stream, ["k", "scraped_date"], "scraped_at", f"{tmp_path}/t", f"{tmp_path}/ck", f"{tmp_path}/late",
                              ties=["run_id"])
    assert {(r.k, r.price) for r in out.collect()} == {("a", 1.0), (None, 7.0), ("b", 2.0), ("c", 2.5)}
    late = spark.read.parquet(f"{tmp_path}/late")
    assert sorted((str(r.k), r.price) for r in late.collect()) == [("None", 7.0), ("a", 3.0), ("z", 5.0)]
    touched = J._touched(spark, f"{tmp_path}/t", spark.createDataFrame(files[0], schema), "scraped_date")
    assert "SortMergeJoin" not in _plan(touched) and "BroadcastHashJoin" in _plan(touched)
