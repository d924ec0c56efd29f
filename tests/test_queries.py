"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from peerscope.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in E.TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "place_id" in df.columns


def test_every_query_has_an_oracle():
    qs, sql = catalog.queries(), catalog.oracle_sql()
    assert set(sql) == set(qs)
    assert len(qs) >= 40


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    from oracle_check import key, norm

    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(norm(r[c]) for c in cols) for r in sdf.collect()), key=key)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(norm(r[i]) for i in idx) for r in cur.fetchall()), key=key)
    assert len(srows) == len(drows)
    assert srows == drows



def test_bench_headline_queries_are_registered():
    import bench
    assert set(bench.HEADLINE) <= set(E.queries())
    assert bench.HEADLINE[0] == "kpi_by_place_year"
