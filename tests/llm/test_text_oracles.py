"""The text queries that SQL can express give the same rows in DuckDB."""

import duckdb
import pytest
from pyspark.sql import Row

from relfold.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found, expected = QUERIES[name](spark, sf_dir), con.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(str, found.select(columns).collect())) == sorted(str(Row(**dict(zip(columns, r, strict=True)))) for r in expected.fetchall())
