"""Every named query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from ripplelog.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(repr(float(r[i])) if isinstance(r[i], float) else repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    found = QUERIES[name](spark, SF)
    expected = db.execute(ORACLE_SQL[name])
    names = [d[0] for d in expected.description]
    assert sorted(found.columns) == sorted(names)
    assert rows_of(found.columns, [tuple(r) for r in found.collect()]) == rows_of(names, expected.fetchall())
