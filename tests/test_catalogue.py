"""Every query of the reference's operators against its SQL, on the same tables."""

import math
from decimal import Decimal

import duckdb
import pytest

from annalist.plans import catalogue

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in found), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_agrees_with_its_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(catalogue.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = rows(columns, cursor.fetchall())
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert catalogue.queries()[name](spark, SF).limit(5).count() > 0
