"""A few registered queries against their DuckDB twins on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NAMES = ["features", "raw_users", "describe_features", "filter_selection", "stratified_split",
         "balance_pass2", "pagerank", "histogram_raw"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
              "labels conversations").split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")
@pytest.mark.parametrize("name", NAMES)
def test_twin(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    want = sorted((tuple(dict(zip(dcols, r))[c] for c in cols) for r in cur.fetchall()), key=repr)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[0] == "username"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")
def test_every_twin_runs(con):
    qs = E.queries()
    for name, sql in E.oracle_sql().items():
        assert name in qs
        rel = con.sql(sql)
        assert len(rel.columns) == len(set(rel.columns)), name
        rel.fetchall()
