"""Generic operators: keys, ranks, dedup, SCD-2, validation, quality, parsing."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfscope.functions import validate as V
from shelfscope.functions.columns import clean_barcode, parse_price_text
from shelfscope.operators import quality as Q
from shelfscope.operators import scd
from shelfscope.operators.dedup import latest_per_key
from shelfscope.operators.keys import rank_within_groups, sequential_key


def test_rank_within_groups_equals_row_number_with_hot_group(spark):
    # one group holds a third of the rows
    rows = [("hot" if i % 3 == 0 else f"g{i % 17}", (i * 7919) % 1000, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v long, id long")
    got = rank_within_groups(df, ["g"], ["v", "id"], "rk", partitions=8)
    want = df.withColumn("rk2", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    j = got.join(want, ["g", "v", "id"])
    assert j.count() == 3000
    assert j.where("rk <> rk2").count() == 0


def test_sequential_key_dense_and_ordered(spark):
    df = spark.createDataFrame([(f"k{i:05d}",) for i in range(1234)], "k string")
    out = sequential_key(df, ["k"], "key").orderBy("k").collect()
    assert [r.key for r in out] == list(range(1, 1235))


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, "w")], "k string, t int, v string")
    got = {r.k: r.v for r in latest_per_key(df, ["k"], ["t"]).collect()}
    assert got == {"a": "y", "b": "w"}


def test_scd2_intervals_contiguous_and_merge_equals_one_pass(spark):
    rows = [("p", dt.datetime(2026, 1, d), float(p)) for d, p in [(1, 10), (2, 10), (3, 12), (4, 12), (5, 9)]]
    obs = spark.createDataFrame(rows, "k string, ts timestamp, price double")
    one = scd.history_from_observations(obs, ["k"], "ts", ["price"], strategy="check")
    vs = one.orderBy("valid_from").collect()
    assert [v.price for v in vs] == [10.0, 12.0, 9.0]
    assert all(a.valid_to == b.valid_from for a, b in zip(vs, vs[1:]))
    assert vs[-1].valid_to is None
    before = obs.where("ts < '2026-01-03'")
    after = obs.where("ts >= '2026-01-03'")
    merged = scd.merge(scd.history_from_observations(before, ["k"], "ts", ["price"], strategy="check"),
                       after, ["k"], "ts", ["price"], strategy="check")
    assert sorted((r.valid_from, r.valid_to, r.price) for r in merged.collect()) == \
        sorted((r.valid_from, r.valid_to, r.price) for r in vs)


def test_hard_delete_invalidate(spark):
    h = scd.history_from_observations(
        spark.createDataFrame([("a", dt.datetime(2026, 1, 1), 1.0), ("b", dt.datetime(2026, 1, 1), 2.0)],
                              "k string, ts timestamp, price double"), ["k"], "ts", ["price"])
    batch = spark.createDataFrame([("a", dt.datetime(2026, 1, 2), 1.5)], "k string, ts timestamp, price double")
    out = scd.merge(h, batch, ["k"], "ts", ["price"], hard_deletes="new_record", as_of=dt.datetime(2026, 1, 3))
    b_rows = sorted(out.where("k = 'b'").collect(), key=lambda r: r.valid_from)
    assert b_rows[0].valid_to == dt.datetime(2026, 1, 3)
    assert b_rows[1].is_deleted and b_rows[1].valid_to is None


OFFER = "struct<Price:double,ListPrice:double,AvailableQuantity:int>"
SCHEMA = (f"productId string, productName string, link string, items array<struct<itemId:string, ean:string, "
          f"sellers:array<struct<sellerId:string, commertialOffer:{OFFER}>>>>")


def _product(pid="100", name="Arroz", link="http://x/p", price=8.99, lp=10.5, qty=150, seller="1", item="i1",
             ean="789-1234567890"):
    return (pid, name, link, [(item, ean, [(seller, (price, lp, qty))] if seller is not None else [])])


@pytest.mark.parametrize("case,bad_rule", [
    (_product(), None),
    (_product(price=-5.0), "VAL-01 offer"),
    (_product(lp=5.0), "VAL-01 offer"),
    (_product(name=""), "VAL-06 productName"),
    (_product(name="x" * 501), "VAL-06 productName"),
    (_product(seller=" "), "VAL-03 seller"),
    (_product(seller=None), "VAL-04 item"),
    (_product(item=""), "VAL-04 item"),
])
def test_product_rules(spark, case, bad_rule):
    df = spark.createDataFrame([case], SCHEMA)
    valid, rejects = V.validate(df, V.product_rules(df))
    if bad_rule is None:
        assert valid.count() == 1 and rejects.count() == 0
    else:
        r = rejects.collect()
        assert len(r) == 1 and bad_rule in r[0].failed_rules


def test_product_normalisation(spark):
    df = spark.createDataFrame([_product(lp=None)], SCHEMA)
    n = V.normalize_product(df).collect()[0]
    assert n.link.startswith("https://")
    assert n["items"][0].ean == "7891234567890"
    assert n["items"][0].sellers[0].commertialOffer.ListPrice == 8.99


def test_flat_products(spark):
    rows = [("1", " Ração ", "89.90", "99.9", True, "10", "Pedigree", "", "http://i/x.jpg", "http://s/p", "1415", "t", None),
            (" ", "B", "1", "2", True, "1", "b", "123", None, None, "1", "t", None),
            ("3", "C", "50", "40", True, "1", "b", None, None, None, "1", "t", None)]
    df = spark.createDataFrame(rows, "productId string, productName string, price string, listPrice string, available "
                                     "boolean, stock string, brand string, ean string, imageUrl string, productUrl "
                                     "string, storeId string, scrapedAt string, platform string")
    valid, rejects = V.validate(V.normalize_flat(df), V.flat_product_rules())
    v = valid.collect()
    assert len(v) == 1 and rejects.count() == 2
    assert v[0].productName == "Ração" and v[0].price == 89.9 and v[0].ean is None
    assert v[0].imageUrl == "https://i/x.jpg" and v[0].platform == "osuper"


def test_quality_tests(spark):
    df = spark.createDataFrame([(1, 10.0), (2, -5.0), (2, 1000000.0), (3, None)], "id int, price double")
    assert Q.unique(df, ["id"]).count() == 1
    assert Q.duplicate_ids(df, "id").count() == 2
    assert Q.accepted_range(df, "price", 0, 100000).count() == 2
    s = Q.summarize(Q.not_null(df, "price"), "not_null", "t", "price").collect()[0]
    assert (s.failures, s.status) == (1, "fail")


def test_columns(spark):
    df = spark.createDataFrame([("R$ 1.234,56",), ("12.99",), ("junk",)], "t string")
    assert [r.p for r in df.select(parse_price_text("t").alias("p")).collect()] == [1234.56, 12.99, None]
    df = spark.createDataFrame([("789-1234567890",), ("12ab",)], "e string")
    assert [r.b for r in df.select(clean_barcode("e").alias("b")).collect()] == ["7891234567890", "12ab"]
