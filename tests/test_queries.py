"""Every query that has SQL gives DuckDB's rows."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import tidemark.queries as core  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def same(df, result):
    names = [x[0] for x in result.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(str([r[names.index(c)] for c in sorted(names)]) for r in result.fetchall())
    return sorted(str(list(r)) for r in df.select(*sorted(names)).collect()) == want


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query(spark, sf_dir, oracle, name):
    df = core.QUERIES[name](spark, sf_dir)
    if name in core.ORACLE_SQL:
        assert same(df, oracle.execute(core.ORACLE_SQL[name]))
    else:
        assert df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    if os.path.isdir("/root/testdata/sf0.001"):
        assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(core.QUERIES) <= set(entry.queries())
