"""Published versions, delta synchronisation, stream state, splitting buckets, evolving schemas, nested
rejects, category trees, selection quantiles and ranks of narrow rows."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfscope import session
from shelfscope.functions import validate as V
from shelfscope.operators import keys, quantiles, scd
from shelfscope.plans import dims, enrichment, incremental
from shelfscope.sinks import writers
from shelfscope.sinks.published import Published, VersionTaken
from shelfscope.sources import bronze, tables
from shelfscope.streaming import jobs

CODES = [f"{i:013d}" for i in range(6)]


# -- versions -----------------------------------------------------------------------------------

def test_versions_appear_whole(spark, tmp_path):
    state = Published(spark, str(tmp_path))
    assert state.current().number == 0 and state.read("t") is None
    v1 = state.commit(state.current(), {"t": [state.stage("t", spark.range(3))]}, {"mark": 1})
    state.stage("t", spark.range(100))                     # a run that failed before it published
    assert state.read("t").count() == 3
    v2 = state.commit(v1, {"t": [*v1.tables["t"], state.stage("t", spark.range(2))]}, {"flag": True})
    assert state.read("t").count() == 5 and state.read("t", at=v1).count() == 3
    assert state.current().values == {"mark": 1, "flag": True} and state.numbers() == [1, 2]
    with pytest.raises(VersionTaken):
        state.commit(v1, {}, {"mark": 9})
    assert state.current() == v2
    assert [p.name for p in (tmp_path / "_versions").iterdir() if p.name.startswith("draft")] == []


def deltas(tmp_path, files):
    for (start, end), recs in files.items():
        (tmp_path / f"delta_{start}_{end}.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in recs) + "\n")
    return str(tmp_path)


def rec(code, name, t=1, grade="a"):
    return {"code": code, "product_name": name, "brands": "b", "nutriscore_grade": grade, "last_modified_t": t}


def synced(spark, tmp_path, name):
    state = Published(spark, str(tmp_path / name))
    base = spark.createDataFrame([(CODES[0], "zero", "b", "a"), (CODES[1], "one", "b", "a")],
                                 "code string, product_name string, brands string, nutriscore_grade string")
    enrichment.import_reference(state, base, 100)
    return state


def rows(state):
    return sorted(tuple(r) for r in enrichment.latest_reference(state).collect())


def test_delta_sync_repeats_a_failed_run(spark, tmp_path, monkeypatch):
    d = tmp_path / "deltas"
    d.mkdir()
    base = deltas(d, {(1, 100): [rec(CODES[2], "stale")], (101, 200): [rec(CODES[0], "zero"), rec(CODES[1], "uno", 5), rec(CODES[1], "eins", 7)],
                      (201, 300): [rec(CODES[1], "one", 1), rec(CODES[3], [{"text": "list"}], 2, "unknown"), rec("123", "short"), '{"code": "bro']})
    codes = spark.createDataFrame([(c,) for c in [*CODES, "123"]], "code string")
    good, failing = synced(spark, tmp_path, "good"), synced(spark, tmp_path, "failing")
    report = enrichment.delta_sync(good, base, codes)
    assert report["files"] == 2 and report["changed"] == 1 and report["malformed"] == 1 and report["refresh"]
    assert rows(good) == [(CODES[0], "zero", "b", "a", 100), (CODES[1], "one", "b", "a", 100), (CODES[3], "list", "b", None, 300)]
    with monkeypatch.context() as m:
        def fail(*_):
            raise OSError("lost")
        m.setattr(Published, "commit", fail)
        with pytest.raises(OSError):
            enrichment.delta_sync(failing, base, codes)
    assert len(rows(failing)) == 2 and failing.current().values["last_timestamp"] == 100
    assert enrichment.delta_sync(failing, base, codes) == report and rows(failing) == rows(good)
    assert enrichment.delta_sync(good, base, codes)["files"] == 0
    assert enrichment.refresh_if_changed(good, "n", lambda r: r.groupBy().count())
    assert not enrichment.refresh_if_changed(good, "n", lambda r: r.groupBy().count())
    assert good.read("n").first()[0] == 3


def test_unchanged_deltas_ask_for_no_refresh(spark, tmp_path):
    d = tmp_path / "deltas"
    d.mkdir()
    base = deltas(d, {(101, 200): [rec(CODES[0], "zero")]})
    state = synced(spark, tmp_path, "s")
    enrichment.refresh_if_changed(state, "n", lambda r: r)
    report = enrichment.delta_sync(state, base, spark.createDataFrame([(c,) for c in CODES], "code string"))
    assert report["changed"] == 0 and not report["refresh"] and not state.current().values["refresh"]
    assert state.current().values["last_timestamp"] == 200


def test_stale_delta_files_are_not_opened(spark, tmp_path):
    base = deltas(tmp_path, {(1, 100): [rec(CODES[0], "old")], (101, 200): [rec(CODES[0], "new")]})
    (tmp_path / "delta_1_100.json").chmod(0)
    (tmp_path / "notes.json").write_text("{}")
    codes = spark.createDataFrame([(CODES[0],)], "code string")
    assert [f[:2] for f in bronze.delta_files(spark, base, 100)] == [(101, 200)]
    got, wm, _ = bronze.read_barcode_deltas(spark, base, 100, codes)
    assert [r.product_name for r in got.collect()] == ["new"] and wm.first()[0] == 200
    assert bronze.read_barcode_deltas(spark, base, 300, codes)[0].count() == 0
    assert bronze.delta_files(spark, f"{base}/none", 0) == []


def test_requested_watermark(spark, tmp_path):
    state = Published(spark, str(tmp_path / "w"))
    codes = lambda *i: spark.createDataFrame([(CODES[k],) for k in i], "code string")
    assert enrichment.request_new(state, codes(0, 1, 1))[0].count() == 2
    new, v = enrichment.request_new(state, codes(1, 2))
    assert [r.ean for r in new.collect()] == [CODES[2]] and v.number == 2
    new, v = enrichment.request_new(state, codes(0, 2))
    assert new.count() == 0 and v.number == 2
    assert sorted((r.ean, r.requested_in) for r in enrichment.requested_barcodes(state).collect()) == \
        [(CODES[0], 1), (CODES[1], 1), (CODES[2], 2)]


# -- streams --------------------------------------------------------------------------------------

SCHEMA = "k string, scraped_date date, scraped_at timestamp, price double"


def land(spark, src, rows):
    spark.createDataFrame([(k, t.date(), t, p) for k, t, p in rows], SCHEMA).coalesce(1).write.mode("append").parquet(src)


def test_latest_in_stream_with_late_rows_and_restart(spark, tmp_path, monkeypatch):
    src, day = str(tmp_path / "src"), lambda d, h=1: dt.datetime(2026, 1, d, h)
    args = (["k", "scraped_date"], "scraped_at", str(tmp_path / "latest"), str(tmp_path / "ck"), str(tmp_path / "late"))

    def run():
        s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        return {(r.k, r.scraped_at): r.price for r in jobs.upsert_latest(spark, s, *args).collect()}

    land(spark, src, [("a", day(1), 1.0), ("a", day(1, 3), 2.0), ("b", day(1), 3.0)])
    land(spark, src, [("a", day(2), 4.0), ("a", day(1, 2), 9.0)])
    first = {("a", day(1, 3)): 2.0, ("b", day(1)): 3.0, ("a", day(2)): 4.0}
    assert run() == first
    land(spark, src, [("a", day(12), 5.0)])
    with monkeypatch.context() as m:            # dies after the target's partitions were staged
        real = jobs._replace_partitions

        def fail(*a):
            raise OSError("lost")
        m.setattr(jobs, "_replace_partitions", fail)
        with pytest.raises(Exception):
            run()
        assert real is not fail
    assert run() == {**first, ("a", day(12)): 5.0}
    land(spark, src, [("a", day(13), 6.0)])
    # day 1 closed long ago: a better record and a new key come too late, a worse record doesn't matter
    land(spark, src, [("a", day(1, 5), 7.0), ("c", day(1), 8.0), ("b", day(1, 0), 0.0), ("a", day(12, 2), 10.0)])
    got = run()
    assert got == {**first, ("a", day(12, 2)): 10.0, ("a", day(13)): 6.0}
    late = spark.read.parquet(str(tmp_path / "late")).collect()
    assert sorted((r.k, r.price) for r in late) == [("a", 7.0), ("c", 8.0)]
    assert not (tmp_path / "latest_hwm").exists()


def test_history_buckets_split_and_small_batches_touch_few(spark, tmp_path):
    src, target = str(tmp_path / "src"), str(tmp_path / "hist")
    rng = random.Random(3)

    def feed():
        s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        return jobs.price_change_feed(spark, s, ["k"], "scraped_at", ["price", "scraped_date"], target, str(tmp_path / "ck"),
                                      check_cols=["price"], bucket_rows=40)

    land(spark, src, [(f"p{i}", dt.datetime(2026, 1, 1), float(rng.randrange(3))) for i in range(300)])
    assert feed().count() == 300
    state = Published(spark, target)
    before = state.current().tables
    names = [n[1:] for n, parts in before.items() if parts]
    assert len(names) > 4 and sum(2.0 ** -len(n) for n in names) == 1.0       # they share no hash and leave none out
    land(spark, src, [("p7", dt.datetime(2026, 1, 2), 9.0)])
    got = feed()
    after = state.current().tables
    changed = [n for n in after if after[n] != before.get(n)]                  # one bucket, or one that split
    assert changed and all(n.startswith(min(changed, key=len)) for n in changed)
    assert got.count() == 301 and got.where("k = 'p7' and valid_to is null").first().price == 9.0
    version = state.current().number
    feed()
    assert state.current().number == version
    one = scd.history_from_observations(spark.read.parquet(src), ["k"], "scraped_at", ["price", "scraped_date"], strategy="check",
                                        check_cols=["price"])
    cols = ["k", "price", "valid_from", "valid_to"]
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, one.select(*cols).collect()))


# -- history ----------------------------------------------------------------------------------------

def test_deleted_key_comes_back(spark):
    t = lambda d: dt.datetime(2026, 1, d)
    obs = lambda *r: spark.createDataFrame(list(r), "k string, ts timestamp, price double")
    for strategy in ("timestamp", "check"):
        args = dict(key=["k"], ts="ts", attrs=["price"], strategy=strategy, hard_deletes="new_record")
        def merge(h, *rows, as_of):        # as a run would, from a stored history
            return scd.merge(spark.createDataFrame(h.collect(), h.schema), obs(*rows), as_of=as_of, **args)
        h = scd.history_from_observations(obs(("a", t(1), 1.0), ("b", t(1), 2.0)), ["k"], "ts", ["price"], strategy=strategy)
        h = merge(h, ("a", t(2), 1.5), as_of=t(3))
        h = merge(h, ("a", t(4), 1.5), as_of=t(5))            # still away: no second deletion
        h = merge(h, ("a", t(6), 1.5), ("b", t(6), 2.0), as_of=t(7))
        b = [(r.valid_from, r.valid_to, r.is_deleted, r.price) for r in h.where("k = 'b'").orderBy("valid_from").collect()]
        assert b == [(t(1), t(3), False, 2.0), (t(3), t(6), True, 2.0), (t(6), None, False, 2.0)]
        h = merge(h, ("a", t(8), 1.5), as_of=t(9))
        assert h.where("k = 'b' and is_deleted").count() == 2 and h.where("k = 'b' and valid_to is null").first().is_deleted


# -- schemas ----------------------------------------------------------------------------------------

def test_reconcile():
    have = {"id": "int", "v": "string", "x": "double"}
    r = incremental.reconcile
    assert r(have, dict(have), "fail") == have
    for policy, batch in [("fail", {**have, "y": "int"}), ("fail", {"id": "int"}), ("ignore", {"id": "int", "v": "string"}),
                          ("ignore", {**have, "id": "bigint"}), ("append_new_columns", {**have, "v": "int"})]:
        with pytest.raises(incremental.SchemaRefused):
            r(have, batch, policy)
    assert r(have, {**have, "y": "int"}, "ignore") == have
    assert r(have, {"id": "bigint", "v": "string", "y": "date"}, "append_new_columns") == {**have, "id": "bigint", "y": "date"}
    assert r(have, {"x": "float", "y": "date"}, "sync_all_columns") == {"x": "float", "y": "date"}
    with pytest.raises(ValueError):
        r(have, {"id": "string"}, "other")


def test_evolving_table_never_brings_dropped_values_back(spark, tmp_path):
    t = incremental.EvolvingTable(spark, str(tmp_path / "t"), "d")
    day = dt.date(2026, 1, 1)
    put = lambda row, schema, policy: t.append(spark.createDataFrame([row], schema), policy)
    put((day, 1, "a"), "d date, id int, v string", "fail")
    put((day, 2 ** 40), "d date, id long", "sync_all_columns")
    assert t.columns() == {"d": "date", "id": "bigint"}
    put((day, 3, "c"), "d date, id long, v string", "append_new_columns")
    assert sorted((r.id, r.v) for r in t.read().collect()) == [(1, None), (3, "c"), (2 ** 40, None)]
    with pytest.raises(incremental.SchemaRefused):
        put((day, 4), "d date, id long", "fail")
    assert t.read().count() == 3


# -- nested rules ---------------------------------------------------------------------------------

PROMO = "struct<promotionId: string, discountValue: double, discountPercentage: double>"
OFFER = f"struct<Price: double, ListPrice: double, PriceWithoutDiscount: double, RewardValue: double, Tax: double, AvailableQuantity: int, Promotions: array<{PROMO}>>"
ITEMS = (f"array<struct<itemId: string, sellers: array<struct<sellerId: string, commertialOffer: {OFFER}>>, "
         "images: array<struct<imageId: string, imageUrl: string>>>>")


def test_nested_rejects_have_places(spark):
    good, bad = (5.0, 6.0, 5.0, 0.0, None, 1, [("p", 1.0, 10.0), ("q", None, None)]), \
        (5.0, None, 4.0, -1.0, -2.0, 1, [("p", 1.0, 100.5), ("q", -1.0, 101.0)])
    items = [("i1", [("s1", good)], [("a", "http://x"), ("b", "  ")]), ("i2", [("s1", good), ("s2", bad)], None), ("i3", None, [("c", None)])]
    df = spark.createDataFrame([("r1", items), ("r2", None), ("r3", [])], f"id string, items {ITEMS}")
    got = sorted(tuple(r) for r in V.offer_rejects(df, ["id"]).collect())
    assert got == [("r1", 2, 2, "s2", "PriceWithoutDiscount"), ("r1", 2, 2, "s2", "RewardValue"), ("r1", 2, 2, "s2", "Tax")]
    got = sorted(tuple(r) for r in V.promotion_rejects(df, ["id"]).collect())
    assert got == [("r1", 2, 2, 1, "p", "discountPercentage"), ("r1", 2, 2, 2, "q", "discountPercentage"), ("r1", 2, 2, 2, "q", "discountValue")]
    assert sorted(tuple(r) for r in V.image_rejects(df, ["id"]).collect()) == [("r1", 1, 2, "b", "imageUrl"), ("r1", 3, 1, "c", "imageUrl")]


def test_product_rules_know_the_full_shape(spark):
    offer = (5.0, 6.0, 4.0, 0.0, None, 1, [("p", -1.0, 10.0)])
    df = spark.createDataFrame([("1", "n", "l", [("i1", [("s1", offer)], [("a", "")])])], f"productId string, productName string, link string, items {ITEMS}")
    _, rejects = V.validate(df, V.product_rules(df))
    assert set(rejects.first().failed_rules) == {"VAL-01 offer", "VAL-02 promotion", "VAL-05 image"}


def test_category_trees_of_any_depth(spark):
    deep = {"id": 0, "name": "bottom", "hasChildren": False, "children": None}
    for i in range(6, 0, -1):
        deep = {"id": i, "name": f"n{i}", "hasChildren": True, "children": [deep]}
    df = spark.createDataFrame([("a", json.dumps([deep])), ("b", "[]"), ("c", None), ("d", "not json"),
                                ("e", json.dumps([{"id": 5, "name": None, "children": [{"id": 6, "name": "x"}]}]))], "doc string, json string")
    got = V.flatten_categories(df, ["doc"]).collect()
    a = sorted((r.depth, r.path, r.id) for r in got if r.doc == "a")
    assert len(a) == 7 and a[-1] == (7, "n1 > n2 > n3 > n4 > n5 > n6 > bottom", 0)
    assert {(r.doc, r.depth, r.id) for r in got if r.doc != "a"} == {("e", 1, 5), ("e", 2, 6)}
    valid, rejects = V.validate(spark.createDataFrame(got), V.category_rules())
    assert sorted((r.doc, r.id) for r in rejects.collect()) == [("a", 0), ("e", 5)]


# -- selection and ranks ----------------------------------------------------------------------------

@pytest.mark.parametrize("small", [0, 45, 4096])
def test_quantiles_by_selection(spark, monkeypatch, small):
    monkeypatch.setattr(quantiles, "CELLS", 64)
    monkeypatch.setattr(quantiles, "SMALL", small)
    rng = random.Random(5)
    data = {"hot": [round(rng.lognormvariate(2, 2), 2) for _ in range(3000)], "flat": [7.0] * 50, "two": [1.0, 1e9], "one": [3.5],
            None: [float(rng.randrange(-5, 5)) for _ in range(41)], "tiny": [1e-300, 2e-300, 0.0, -1e300]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs] + [("one", None), ("empty", None)], "g string, v double").repartition(6)
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    got = quantiles.group_quantiles(df, ["g"], "v", probs)
    assert "Window" not in got._jdf.queryExecution().toString()
    found = {r.g: tuple(r)[1:] for r in got.collect()}
    assert set(found) == set(data)
    for g, vs in data.items():
        assert np.allclose(found[g], np.quantile(vs, list(probs.values())), rtol=1e-12)


def test_one_row_group_is_dealt_to_all_cores(spark, tmp_path):
    spark.range(50_000).selectExpr("id", "cast(id % 7 as string) as name").coalesce(1).write.parquet(str(tmp_path / "one"))
    spark.range(5_000).repartition(40).write.option("parquet.block.size", 1024).parquet(str(tmp_path / "many"))
    one, many = (spark.read.parquet(str(tmp_path / n)) for n in ("one", "many"))
    got = tables.spread(one)
    assert got.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert min(got.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) > 0
    assert got.agg(F.count("*"), F.sum("id")).first() == one.agg(F.count("*"), F.sum("id")).first()
    plan = got.where("id > 49000").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,49000)" in plan and "name" not in plan.split("ReadSchema")[1]
    with pytest.MonkeyPatch.context() as m:          # a table with splits enough keeps them
        m.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda self: 1))
        splits = many.rdd.getNumPartitions()
        assert splits >= 2 and tables.spread(many).rdd.getNumPartitions() == splits


def test_independent_work_side_by_side(spark):
    assert [r.first()[0] for r in session.together(spark, *[lambda n=n: spark.range(n).selectExpr("count(*)") for n in (3, 4)])] == [3, 4]
    with pytest.raises(ValueError, match="second"):
        session.together(spark, lambda: 1, lambda: (_ for _ in ()).throw(ValueError("second")))


def test_ranks_of_narrow_rows(spark):
    rng = random.Random(6)
    rows = [("g" if i % 3 else "h", i, rng.randrange(5), float(rng.randrange(4)), "wide" * 20) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, id int, a int, b double, text string").repartition(7)
    got = keys.ranks_within_groups(df, ["g"], {"ra": [(F.col("a"), True), "id"], "rb": [(F.col("b") + 1, False), (F.col("a"), True), "id"]}, ["g", "id"])
    for name, order in (("ra", lambda r: (-r[2], r[1])), ("rb", lambda r: (r[3], -r[2], r[1]))):
        want = {r[1]: n + 1 for g in "gh" for n, r in enumerate(sorted((r for r in rows if r[0] == g), key=order))}
        assert {r.id: r[name] for r in got.collect()} == want


# -- runs, targets, regions ----------------------------------------------------------------------------

def test_a_failing_report_keeps_the_old_marker(spark, tmp_path):
    state = Published(spark, str(tmp_path / "run"))
    at = dt.datetime(2026, 3, 1, 6)
    assert writers.read_marker(state).count() == 0
    writers.publish_run(state, {"a": spark.range(3), "b": lambda: spark.range(2)}, at, "1.0")

    def broken():
        raise RuntimeError("no source")
    with pytest.raises(RuntimeError):
        writers.publish_run(state, {"a": spark.range(9), "b": broken}, at + dt.timedelta(days=1), "1.1")
    m = {r.output: (r.last_pipeline_run, r.status, r.version, r.rows) for r in writers.read_marker(state).collect()}
    assert m == {"a": (at, "completed", "1.0", 3), "b": (at, "completed", "1.0", 2)} and state.read("a").count() == 3
    writers.publish_run(state, {"a": spark.range(9)}, at + dt.timedelta(days=1), "1.1")
    assert state.read("a").count() == 9 and writers.read_marker(state).first().version == "1.1"


def test_failed_report_keeps_its_message(spark, tmp_path):
    bad = spark.range(3).select(F.assert_true(F.col("id") > 5, "ids are small"))
    row = writers.write_bundle(spark, {"x": bad}, str(tmp_path / "bundle")).first()
    assert row.status.startswith("failed: ") and len(row.status) > len("failed: SparkRuntimeException: ")


def test_store_regions_differ(spark):
    seed = {(r.store, r.region_code): r.hub_id for r in dims.region_seed(spark).collect()}
    assert len({s for s, _ in seed}) == 7 and len(seed) == 47
    assert seed["bistek", "florianopolis_costeira"] != seed["fort", "florianopolis_costeira"]
    assert ("giassi", "florianopolis_costeira") not in seed


# -- entry ---------------------------------------------------------------------------------------------

def test_entry_without_a_library_or_the_subpackage(monkeypatch):
    import __spark_entry__ as entry

    def missing(name):
        def load(module):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return load
    monkeypatch.setattr(entry.importlib, "import_module", missing("shelfscope.llm"))
    assert "M-14" in entry.queries() and "pipeline" not in entry.queries() and "M-14" in entry.oracle_sql()
    monkeypatch.setattr(entry.importlib, "import_module", missing("somelibrary"))
    with pytest.warns(UserWarning, match="somelibrary"):
        assert "M-14" in entry.queries()
    monkeypatch.setattr(entry.importlib, "import_module", missing("shelfscope.session"))
    with pytest.raises(ModuleNotFoundError):
        entry.queries()
