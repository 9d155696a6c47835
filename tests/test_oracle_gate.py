"""Every registered query equals its DuckDB oracle at sf0.001 (the driver checks sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from shelfprice.plans.queries import QUERIES

from small_data import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if x is None:
            return (0, "")
        if isinstance(x, float):
            return (1, "nan" if math.isnan(x) else repr(x))
        return (2, str(x))
    return sorted(tuple(v(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    drows = rel.fetchall()
    assert len(srows) == len(drows)
    assert norm(df.columns, srows) == norm(rel.columns, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["storeId", "categoryName", "subcategoryName", "avg_price_discount_new",
                          "avg_price_regular_new", "city"]
