"""Every registered query against its SQL, on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as entry
from verification.oracles import ORACLES
from verification.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


@pytest.fixture(scope="module")
def db(folder):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, folder, name):
    df = QUERIES[name](spark, folder)
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    result = db.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = [tuple(r[i] for i in at) for r in result.fetchall()]
    order = lambda row: tuple((v is None, str(v)) for v in row)
    assert sorted(got, key=order) == sorted(want, key=order)


def test_entry(spark):
    assert {r["type"]: r["n"] for r in entry.entry(spark).collect()} == {"like": 96, "repost": 84}
