import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from variantloom import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def same(spark, query, sql):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path if os.path.isfile(path) else path + '/*.parquet'}')")
    got, want = query(spark, SF).toPandas(), con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    plain = lambda v: None if pd.isna(v) else str(v) if isinstance(v, str) else float(v)
    rows = lambda x: sorted(repr(tuple(plain(v) for v in r)) for r in x[sorted(x.columns)].itertuples(index=False))
    assert rows(got) == rows(want)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_as_sql(spark, name):
    same(spark, registry.QUERIES[name], registry.ORACLES[name])


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_entry(spark):
    assert entry.entry(spark).columns[0] == "meta_aa_changes"
    assert set(entry.oracle_sql()) <= set(entry.queries())
