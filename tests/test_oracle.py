"""Every query with SQL gives the rows that SQL gives on another engine."""

import decimal

import duckdb
import pytest

from changeloom.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def _plain(value):
    return float(value) if isinstance(value, decimal.Decimal) else value


def _sorted(names, fetched):
    order = sorted(range(len(names)), key=lambda i: names[i])
    found = [tuple(_plain(r[i]) for i in order) for r in fetched]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert _sorted(df.columns, [tuple(r) for r in df.collect()]) == _sorted(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
