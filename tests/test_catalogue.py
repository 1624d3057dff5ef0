"""Every query with SQL against DuckDB, on the smallest tables."""

import os

import pytest

from leadlink.plans import runs  # noqa: F401  adds its queries
from leadlink.plans.catalogue import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings clients"


def rows(df):
    df = df[sorted(df.columns)]
    df = df.astype(object).where(df.notna(), None)
    shown = lambda v: None if v is None else f"{v:.6f}" if isinstance(v, float) else str(v)
    return sorted(str([shown(v) for v in r]) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(DIR):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for t in TABLES.split():
        c.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    mine, other = QUERIES[name](spark, DIR).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(mine.columns) == sorted(other.columns)
    assert rows(mine) == rows(other)
