"""Every registered query with an oracle matches DuckDB on the given tables.

Runs at sf0.001 by default (set LOGWEAVE_ORACLE_SF to another directory, e.g.
/root/testdata/sf0.01, for the driver's scale).
"""

import os

import pytest
from paths import SF_SMALL

import __spark_entry__ as entry
from oracle import compare

SF = os.environ.get("LOGWEAVE_ORACLE_SF", SF_SMALL)
SQL = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, entry.queries()[name], SQL[name], SF)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["exact"], r


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["user_id", "user_name", "memory_mb", "disk_gb", "n_claims"]
    # ordered by memory, then disk
    mem = [r.memory_mb for r in rows]
    assert mem == sorted(mem)
