"""Every registered query against the SQL that must give the same rows."""

import duckdb
import pytest

from snapdiff.workload import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf}/{name}.parquet'")
    yield con
    con.close()


def rows_of(columns, order, rows):
    at = [columns.index(c) for c in order]
    return sorted((repr(tuple(row[i] for i in at)) for row in rows))


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_same_rows(spark, sf, duck, name):
    query = QUERIES[name]
    got = query.run(spark, sf)
    want = duck.sql(query.sql)
    order = sorted(want.columns)
    assert sorted(got.columns) == order
    kinds = {f.name: TYPES.get(f.dataType.simpleString()) for f in got.schema}
    assert kinds == {c: str(t) for c, t in zip(want.columns, want.types)}
    expected = rows_of(want.columns, order, want.fetchall())
    assert expected, "the query must return rows"
    assert rows_of(got.columns, order, [tuple(r) for r in got.collect()]) == expected


def test_every_query_has_sql():
    assert [n for n, q in QUERIES.items() if q.sql is None] == []
