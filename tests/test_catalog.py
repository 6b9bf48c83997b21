"""Every query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from tagweave.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in "documents benchmark labels pages conversations events part supplier customer lineitem".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))
    want = sorted(map(str, con.execute(f"SELECT {', '.join(f'\"{c}\"' for c in columns)} FROM ({registry.oracle_sql()[name]})").fetchall()))
    assert got == want
