"""The correctness gate: every named query with a DuckDB twin must return
the same rows (order-insensitive, doubles rounded) on the small tables."""

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SF_ORACLE, SF_SMALL
from millrace.sources.fixtures import TABLES
from tools.oracle_check import digest

ORACLE = se.oracle_sql()


@pytest.fixture(scope="module", params=[SF_ORACLE, SF_SMALL], ids=["sf0.01", "sf0.001"])
def duck(request):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{request.param}/{t}.parquet')")
    return request.param, con


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0 and "OEE" in df.columns


def test_every_query_has_callable():
    assert set(ORACLE) <= set(se.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sf_dir, con = duck
    df = se.queries()[name](spark, sf_dir)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(scols, srows)[0] == digest(dcols, drows)[0]
