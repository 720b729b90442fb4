"""Physical plans: filters reach the scan, partition predicates stay partition filters."""

import contextlib
import io

import __spark_entry__ as entry

from .conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_in_flight_exclusion_is_a_partition_filter(spark):
    p = _plan(entry.queries()["SRC-02"](spark, SF_SMALL))
    assert "PartitionFilters: [" in p and "make_date" in p.split("PartitionFilters: [", 1)[1].split("\n", 1)[0]


def test_price_index_pushes_filter_and_prunes_columns(spark):
    from shelfscope.plans import facts
    from shelfscope.plans.warehouse import warehouse
    p = _plan(facts.fct_daily_price_index(warehouse(spark, SF_SMALL).tru()))
    assert "ObjectHashAggregate" not in p  # no map of a group's values
    assert "PushedFilters: [IsNotNull(min_price)]" in p
    schema = [l for l in p.splitlines() if l.startswith("ReadSchema")][0]
    assert "product_url" not in schema and "eans" not in schema


def test_deal_ranks_need_no_window_over_a_store_day(spark):
    from shelfscope.plans import facts
    from shelfscope.plans.warehouse import warehouse
    p = _plan(facts.fct_hot_deals_validated(warehouse(spark, SF_SMALL).fact("fct_active_promotions")))
    assert "Window" not in p or "row_number" not in p


def test_quality_suite_scans_once(spark):
    assert _plan(entry.queries()["DQ-01"](spark, SF_SMALL)).count("Scan parquet") == 2  # once, and its details


def test_page_extraction_is_row_local(spark):
    from shelfscope.sources import pages
    d = spark.createDataFrame([(1, "u", "<h1>x</h1>", 200)], "page_id long, url string, html string, status int")
    for f in (pages.jsonld_products, pages.live_prices):
        assert "Exchange" not in _plan(f(d))


def test_trusted_dedup_sorts_no_aggregate(spark):
    from shelfscope.plans.trusted import tru_product
    from shelfscope.plans.warehouse import warehouse
    assert "SortAggregate" not in _plan(tru_product(warehouse(spark, SF_SMALL).stg()))


def test_star_join_plan(spark):
    from shelfscope.plans import facts
    from shelfscope.plans.warehouse import warehouse
    w = warehouse(spark, SF_SMALL)
    df = facts.fct_daily_prices(w.tru(), w.dim("dim_product"), w.dim("dim_store"), w.dim("dim_region"),
                                w.dim("dim_date"), w.dim("dim_brand"), w.dim("dim_ean"))
    p = _plan(df)
    # the store seed is broadcast by hint; small dimensions by measured size
    assert p.count("BroadcastHashJoin") >= 2
    assert "SortAggregate" not in p
