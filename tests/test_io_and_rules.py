"""Operators without a driver-data query: promotion / image / category rules,
schema routing, JSON report, freshness marker, schema-change policy."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfscope.functions import validate as V
from shelfscope.plans import incremental as I
from shelfscope.sinks import writers as W


def test_promotion_rule(spark):
    df = spark.createDataFrame([((5.0, 10.0),), ((-1.0, 10.0),), ((1.0, 120.0),)],
                               "p struct<discountValue:double, discountPercentage:double>")
    got = [r.ok for r in df.select(V.promotion_ok(F.col("p")).alias("ok")).collect()]
    assert got == [True, False, False]


def test_image_rule_and_https(spark):
    df = spark.createDataFrame([([("1", "http://x/a.jpg")],), ([("2", " ")],)],
                               "images array<struct<imageId:string, imageUrl:string>>")
    assert [r.ok for r in df.select(V.image_rules(F.col("images")).alias("ok")).collect()] == [True, False]
    fixed = df.select(V.normalize_images(F.col("images")).alias("i")).collect()[0].i[0].imageUrl
    assert fixed == "https://x/a.jpg"


def test_category_rules(spark):
    df = spark.createDataFrame([(1, "Food"), (0, "Bad"), (2, "")], "id int, name string")
    valid, rejects = V.validate(df, V.category_rules())
    assert valid.count() == 1 and rejects.count() == 2


def test_schema_routing():
    assert W.schema_for("prod", "marts") == "marts"
    assert W.schema_for("ci", "marts") == "marts"
    assert W.schema_for("dev", "marts", "ana") == "ana_marts"


def test_json_report_and_marker(spark):
    d = tempfile.mkdtemp(prefix="shelfscope-test-")
    rep = spark.createDataFrame([(10, 2)], "hot_deals long, suspicious long").select(
        F.struct("hot_deals", "suspicious").alias("summary"), F.lit("sf").alias("params"))
    W.write_json_report(rep, f"{d}/report")
    back = spark.read.json(f"{d}/report").collect()[0]
    assert back.summary.hot_deals == 10
    W.write_marker(spark, f"{d}/marker", dt.datetime(2026, 3, 1), "success", "1.0")
    W.write_marker(spark, f"{d}/marker", dt.datetime(2026, 3, 2), "success", "1.1")
    m = spark.read.parquet(f"{d}/marker").collect()
    assert len(m) == 1 and m[0].version == "1.1"


def test_schema_change_policies(spark):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    new = spark.createDataFrame([(2, "b", 3.0)], "id int, v string, extra double")
    with pytest.raises(ValueError):
        I.apply_schema_change(old, new, "fail")
    assert I.apply_schema_change(old, new, "ignore").columns == ["id", "v"]
    assert I.apply_schema_change(old, new, "append_new_columns").columns == ["id", "v", "extra"]


def test_merge_upsert_updates_only_given_columns(spark):
    t = spark.createDataFrame([(1, 10.0, "x"), (2, 20.0, "y")], "k int, price double, note string")
    s = spark.createDataFrame([(2, 25.0, "changed"), (3, 30.0, "z")], "k int, price double, note string")
    out = {r.k: (r.price, r.note) for r in I.merge_upsert(t, s, ["k"], update_columns=["price"]).collect()}
    assert out == {1: (10.0, "x"), 2: (25.0, "y"), 3: (30.0, "z")}


def test_breakdown_for_unknown_run(spark):
    from shelfscope.plans import observability as O
    from shelfscope.sources import adapter
    from .conftest import SF_SMALL
    b = adapter.scraper_batches(spark, SF_SMALL)
    runs = O.fold_runs(adapter.run_events(b))
    rid = runs.select("run_id").first().run_id
    assert O.breakdown_for(runs, b, rid).count() == 1
    with pytest.raises(ValueError):
        O.breakdown_for(runs, b, "no-such-run")


def test_approximate_quantiles_path(spark):
    from shelfscope.plans.facts import fct_daily_price_index
    from shelfscope.plans.warehouse import warehouse
    from .conftest import SF_SMALL
    t = warehouse(spark, SF_SMALL).tru()
    exact = {(r.supermarket, r.region, r.scraped_date): r.p95_product_price
             for r in fct_daily_price_index(t).collect()}
    approx = fct_daily_price_index(t, exact_quantiles=False).collect()
    assert len(approx) == len(exact)
    assert all(r.p95_product_price is not None for r in approx)


def test_incremental_partition_overwrite_is_idempotent(spark):
    import datetime as dt2
    from shelfscope.plans.warehouse import warehouse
    from .conftest import SF_SMALL
    t = warehouse(spark, SF_SMALL).tru().select("product_id", "supermarket", "region", "scraped_date", "min_price")
    p = tempfile.mkdtemp(prefix="shelfscope-inc-") + "/t"
    first = I.run_incremental(spark, t, p, dt2.date(2026, 2, 20)).count()
    again = I.run_incremental(spark, t, p, dt2.date(2026, 2, 20)).count()
    assert first == again == t.count()
