"""Work whose disk grows no faster than its input: what is shuffled, how wide, how often."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from shelfscope.operators import scd
from shelfscope.plans import facts, history
from shelfscope.plans.staging import stg_products
from shelfscope.plans.trusted import tru_product
from shelfscope.session import size_work
from shelfscope.sources import adapter

from .conftest import SF_SMALL

KEY, TS = ["p", "s"], "at"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df):
    return len(re.findall(r"\bExchange (?:hash|range|Round|Single)", _plan(df)))


def test_trusted_rows_are_not_sorted_before_their_shuffle(spark):
    """F4, F10, F13-F15, F20-F23: the dedup sorted all wide rows of a split, and spilled."""
    plan = _plan(tru_product(stg_products(adapter.bronze_products(spark, SF_SMALL))))
    below = plan[plan.index("rangepartitioning(product_id"):]
    assert "WindowGroupLimit" not in below and "hashpartitioning(product_id" not in plan


def test_splits_and_partitions_grow_with_the_input(spark, tmp_path):
    names = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes"]
    (tmp_path / "t").write_bytes(b"0" * (40 << 20))
    size_work(spark, str(tmp_path))
    assert [int(spark.conf.get(n)) for n in names] == [20, 16 << 20]
    size_work(spark, SF_SMALL)
    assert int(spark.conf.get(names[0])) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_wide_rows_meet_products_and_barcodes_in_one_shuffle(spark):
    """F10, F12-F14: one shuffle of the trusted rows for both large dimensions; a product without
    barcode, one with two and a barcode no dimension has."""
    d = dt.date(2026, 1, 1)
    rows = [("1", ["a"]), ("1", None), ("1", ["b"]), ("2", ["a"]), ("3", ["z"]), ("4", ["a"])]
    tru = spark.createDataFrame([(p, e, "n", "s", "r", None, 1.0, 1.0, 1.0, 2.0, 1, True, 1, "x", d, dt.datetime(2026, 1, 1)) for p, e in rows],
                                "product_id string, eans array<string>, product_name string, supermarket string, region string, brand string, "
                                "min_price double, max_price double, avg_price double, min_list_price double, sku_count long, "
                                "is_available boolean, total_available_quantity long, run_id string, scraped_date date, scraped_at timestamp")
    one = lambda rows, schema: spark.createDataFrame(rows, schema)
    args = [tru, one([("1", 1), ("2", 2), ("3", 3)], "product_id string, product_key long"), one([("s", 1)], "store_id string, store_key long"),
            one([("r", 1)], "region_code string, region_key long"), one([(d, 20260101)], "date_day date, date_key int"),
            one([("b", 1)], "brand_name string, brand_key long"), one([("a", 1), ("b", 2)], "ean_code string, ean_key long")]
    out = facts.fct_daily_prices(*args)
    got = sorted((r.product_key, r.ean_key or 0) for r in out.collect())
    assert got == [(1, 0), (1, 1), (1, 2), (2, 1), (3, 0)]
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert len(re.findall(r"hashpartitioning\(_ean1", _plan(facts.fct_daily_prices(*args)))) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def _obs(spark, rows):
    return spark.createDataFrame([(p, "s", dt.datetime(2026, 1, d), v) for p, d, v in rows], "p string, s string, at timestamp, v double")


@pytest.mark.parametrize("strategy", ["timestamp", "check"])
def test_merge_shuffles_history_and_batch_once(spark, strategy):
    """history and batch were shuffled for every one of the joins that told them apart."""
    hist = scd.history_from_observations(_obs(spark, [("a", 1, 1.0), ("a", 3, 1.0), ("b", 1, 5.0)]), KEY, TS, ["v", TS], strategy)
    batch = _obs(spark, [("a", 3, 1.0), ("a", 2, 2.0), ("a", 5, 2.0), ("c", 4, 1.0)])
    out = scd.merge(hist, batch, KEY, TS, ["v", TS], strategy, hard_deletes="new_record", as_of=dt.datetime(2026, 1, 9))
    assert _exchanges(out) <= _exchanges(hist) + 1
    got = sorted((r.p, r.valid_from.day, r.valid_to.day if r.valid_to else 0, r.v, r.is_deleted) for r in out.collect())
    a = [(1, 2, 1.0), (2, 3, 2.0), (3, 5, 1.0), (5, 0, 2.0)]
    if strategy == "check":  # the row of day 3 equalled day 1's, so the history never had it, and the batch brings it
        assert [g for g in got if g[0] == "a"] == [("a", *x, False) for x in a]
    else:
        assert [g for g in got if g[0] == "a"] == [("a", *x, False) for x in a]
    assert [g for g in got if g[0] != "a"] == [("b", 1, 9, 5.0, False), ("b", 9, 0, 5.0, True), ("c", 4, 0, 1.0, False)]


def test_merge_leaves_null_keys_and_foreign_ids_alone(spark):
    hist = scd.history_from_observations(_obs(spark, [(None, 1, 1.0), ("b", 1, 5.0), ("a", 1, 1.0)]), KEY, TS, ["v", TS])
    hist = hist.withColumn("scd_id", F.lit("mine")).withColumn("note", F.lit("n"))
    out = scd.merge(hist, _obs(spark, [(None, 1, 2.0), ("a", 2, 2.0)]), KEY, TS, ["v", TS])
    got = sorted((r.p or "", r.v, r.valid_to is None, r.scd_id == "mine", r.note or "") for r in out.collect())
    assert got == [("", 1.0, True, True, "n"), ("", 2.0, True, False, ""), ("a", 1.0, False, False, ""), ("a", 2.0, True, False, ""),
                   ("b", 5.0, True, True, "n")]


def test_later_looks_come_from_one_scan(spark):
    """the trusted rows were read once per look."""
    tru = spark.range(4).select(F.col("id").cast("string").alias("product_id"), F.timestamp_seconds("id").alias("scraped_at"),
                                F.lit(dt.date(1970, 1, 1)).alias("scraped_date"), F.lit(1.0).alias("min_price"))
    out = history.with_rescrapes(tru)
    assert out.columns == tru.columns and _plan(out).count("Range (0, 4") == 1
    assert sorted((r.product_id, r.scraped_date.day, r.min_price) for r in out.collect()) == sorted(
        (str(i), d, 1.1 if d == 3 and i % 3 == 0 else 1.0) for i in range(4) for d in (1, 2, 3))
