"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from marginalia.plans import CHECK_SQL, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{small}/{name}.parquet'")
    return connection


def in_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(CHECK_SQL))
def test_equals_sql(spark, small, duck, name):
    frame = QUERIES[name](spark, small)
    got = in_order(frame.columns, frame.collect())
    cursor = duck.execute(CHECK_SQL[name])
    assert got == in_order([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECK_SQL)))
def test_runs_without_sql(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_every_check_belongs_to_a_query():
    assert set(CHECK_SQL) <= set(QUERIES)
