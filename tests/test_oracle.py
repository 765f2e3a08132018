"""Driver contract: every registered query equals its DuckDB oracle SQL."""

from conftest import SF_SMALL
from tools.oracle_check import compare

import __spark_entry__ as entry


def test_contract_keys():
    assert set(entry.all_queries()) == set(entry.all_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 50


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["RunMonth", "Country", "total_sales", "units", "lines"]


def test_all_queries_match_oracle_sf0001(spark):
    res = compare(spark, SF_SMALL, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    assert not bad, bad
