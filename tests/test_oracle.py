"""Every registered query against its DuckDB restatement (sf0.001)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from airlake.plans import oracle, registry  # noqa: E402
from check_oracle import rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.oracle_sql())


def test_entry_has_every_query():
    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    res = duck.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "aqi_rank" in df.columns


@pytest.mark.parametrize(
    "conf",
    [
        {"spark.sql.session.timeZone": "America/New_York"},
        {"spark.sql.session.timeZone": "Asia/Kolkata", "spark.sql.ansi.enabled": "false"},
    ],
)
@pytest.mark.parametrize(
    "key", ["typed_readings", "latest_readings", "data_freshness_cloud", "daily_city_ranking", "flatten_hourly"]
)
def test_results_do_not_depend_on_session_settings(spark, duck, conf, key):
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = entry.queries()[key](spark, SF)
        got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    res = duck.execute(entry.oracle_sql()[key])
    assert got == rows_of([d[0] for d in res.description], res.fetchall())
