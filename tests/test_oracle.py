"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01), plus the entry smoke check."""

import pytest

from conftest import SF_SMALL
from oracle_check import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

KEYS = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, key, queries()[key], oracle_sql().get(key), SF_SMALL, con)
    assert r["status"] in ("ok", "rows-only"), r


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) >= 0
    assert df.columns == ["category", "year", "n_lines", "n_quarantined", "amount_eur",
                          "amount_deflated", "co2e_kg", "uncertainty_kg"]
