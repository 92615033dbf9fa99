"""The registered queries that have SQL, against it."""

import duckdb
import pytest

from commitfold.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, folder, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    df = QUERIES[name](spark, folder)
    cols = sorted(df.columns)
    result = db.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    order = lambda row: tuple((v is None, str(v)) for v in row)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=order)
    assert got == sorted((tuple(r[names.index(c)] for c in cols) for r in result.fetchall()), key=order)
