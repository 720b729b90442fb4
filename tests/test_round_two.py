"""Nothing is dropped silently; storage is shared; exact arithmetic at four decimals."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfscope import session
from shelfscope.functions.columns import money_avg, money_sum
from shelfscope.operators import scd
from shelfscope.operators.quantiles import group_quantiles
from shelfscope.plans.quality_report import hot_deal_quality, suspicious_top
from shelfscope.sources import bronze


def test_cluster_without_shared_folder_is_an_error(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())
    for master, local in (("local", True), ("local[8]", True), ("local-cluster[3,2,1000]", False), ("yarn", False)):
        Session.sparkContext.master = master
        assert session.is_local(Session()) is local


def test_missing_folder_is_empty_but_a_broken_one_raises(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.StringType())])
    assert bronze.discover_jsonl(spark, f"{tmp_path}/none", schema).count() == 0
    with pytest.raises(Exception):
        bronze.discover_jsonl(spark, "nosuchscheme://x/y", schema).count()
    assert len(schema) == 1


def test_malformed_delta_lines_are_kept(spark, tmp_path):
    d = tmp_path / "delta_100_200.json"
    d.write_text('{"code":"1234567890123","product_name":"x","last_modified_t":1}\n{"code": "broken\n')
    codes = spark.createDataFrame([("1234567890123",)], "code string")
    recs, wm, bad = bronze.read_barcode_deltas(spark, str(tmp_path), 150, codes)
    assert recs.count() == 1 and [r.line for r in bad.collect()] == ['{"code": "broken'] and wm.first()[0] == 200


def test_null_moving_between_columns_opens_a_version(spark):
    t = [dt.datetime(2026, 1, d) for d in (1, 2, 3)]
    obs = spark.createDataFrame([("p", t[0], None, 5.0), ("p", t[1], 5.0, None), ("p", t[2], 5.0, None)],
                                "k string, ts timestamp, a double, b double")
    assert scd.history_from_observations(obs, ["k"], "ts", ["a", "b"], strategy="check").count() == 2


@pytest.mark.parametrize("strategy", ["check", "timestamp"])
def test_late_rows_take_their_place(spark, strategy):
    t = [dt.datetime(2026, 1, d) for d in range(1, 7)]
    rows = [("p", t[0], 1.0), ("p", t[1], 2.0), ("p", t[2], 2.0), ("p", t[4], 3.0), ("q", t[1], 9.0)]
    late = [("p", t[3], 7.0), ("p", t[5], 3.0), ("p", t[0], 1.0)]
    make = lambda r: spark.createDataFrame(r, "k string, ts timestamp, price double")
    args = (["k"], "ts", ["price"])
    hist = scd.history_from_observations(make(rows), *args, strategy=strategy)
    got = scd.merge(hist, make(late), *args, strategy=strategy)
    want = scd.history_from_observations(make(rows + late[:2]), *args, strategy=strategy)
    cols = ["k", "price", "valid_from", "valid_to"]
    assert sorted(got.select(*cols).collect(), key=str) == sorted(want.select(*cols).collect(), key=str)


def test_zero_list_price_does_not_raise(spark):
    d = spark.createDataFrame([("s", "1", "n", 0.0, 0.0, "r", dt.datetime(2026, 1, 1)), ("s", "2", "n", 5.0, 20.0, "r", dt.datetime(2026, 1, 1))],
                              "supermarket string, sku string, name string, price double, list_price double, region string, collected_at timestamp")
    assert hot_deal_quality(d).count() > 0 and suspicious_top(d).count() == 1


def test_money_keeps_four_decimals(spark):
    d = spark.createDataFrame([(1.0005,), (2.0,), (None,)], "x double")
    r = d.agg(money_sum("x").alias("s"), money_avg("x").alias("a")).first()
    assert r.s == 3.0005 and r.a == pytest.approx(1.50025, abs=1e-12)


def test_group_quantiles(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 40, 500) / 4
    rows = [(None if i % 50 == 0 else f"g{i % 3}", float(v)) for i, v in enumerate(x)] + [("g0", None), ("one", 2.0)]
    d = spark.createDataFrame(rows, "g string, v double")
    probs = {"a": 0.25, "b": 0.5, "c": 0.95}
    got = {r.g: r for r in group_quantiles(d, ["g"], "v", probs).collect()}
    for g in (None, "g0", "g1", "g2", "one"):
        v = [b for a, b in rows if a == g and b is not None]
        for n, p in probs.items():
            assert got[g][n] == pytest.approx(np.quantile(v, p))


def test_all_gaps_are_reported(spark):
    from shelfscope.plans.reports import r04_arbitrage
    d = spark.range(10_500).select(F.col("id").cast("string").alias("ean"), F.lit("n").alias("name"),
                                   F.explode(F.array(*[F.struct(F.lit(s).alias("supermarket"), F.lit(p).alias("price"))
                                                       for s, p in (("a", 1.0), ("b", 2.0))])).alias("x")).select("ean", "name", "x.*")
    assert r04_arbitrage(d).count() == 10_500 and r04_arbitrage(d, limit=5).count() == 5
