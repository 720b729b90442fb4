"""Every registered query equals its DuckDB twin on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from shelfscope.sources.tables import TABLES, table_path
from tools.compare import frame_hash

from .conftest import SF_SMALL

ORACLE = entry.oracle_sql()
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    if name.startswith(("SRC-", "STR-01")):
        entry.queries()[name](spark, SF_SMALL).schema  # a second call in one session must work too
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert frame_hash(got)[0] == frame_hash(want)[0]


def test_every_query_has_a_callable():
    qs = entry.queries()
    assert set(ORACLE) <= set(qs)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "quality_score" in df.columns
