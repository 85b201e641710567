"""Each query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def shown(v):
    if v is None or v != v:
        return "-"
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) & set(entry.oracle_sql())))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == columns
    place = [rel.columns.index(c) for c in columns]
    want = sorted(tuple(shown(float(r[i]) if type(r[i]).__name__ == "Decimal" else r[i]) for i in place) for r in rel.fetchall())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
