"""Every query with an SQL twin gives the same rows in DuckDB."""

import duckdb
import pytest

from relfold.catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    return "" if value is None else repr(value) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    place = [names.index(c) for c in sorted(names)]
    expected = sorted(tuple(plain(row[i]) for i in place) for row in found.fetchall())
    rows = sorted(tuple(plain(row[c]) for c in sorted(names)) for row in df.collect())
    assert rows and rows == expected


def test_every_query_is_registered_once_and_described():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 120
