"""Every registered query against its DuckDB SQL at sf0.001 (rows-only where no SQL is given)."""

import duckdb
import pytest

import __spark_entry__ as E
from corpusloom.sources.testdata import TABLES
from scripts.compare import digest

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(rows) >= 0
        return
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]
