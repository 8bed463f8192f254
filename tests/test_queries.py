"""Every cube and report against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from turnstone.plans import cubes, reports

TABLES = "/root/testdata/sf0.001"
SQL = cubes.SQL | reports.SQL
QUERIES = cubes.QUERIES | reports.QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(TABLES):
        connection.execute(f"create view {name.split('.')[0]} as select * from '{TABLES}/{name}'")
    return connection


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    show = lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, TABLES)
    rows = [tuple(r) for r in got.collect()]
    if name not in SQL:
        assert rows
        return
    want = duck.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(rows, got.columns) == plain(want.fetchall(), want.columns)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_lsh_recall(spark):
    """Approximate neighbours hold nine tenths of the exact ones."""
    from turnstone.operators import vectors

    every = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    queries = every.where("vec_id % 50 = 0")
    exact = {}
    for q in queries.collect():
        hits = vectors.top_k(every, every.where(f"vec_id = {q.vec_id}"), 11).collect()
        exact[q.vec_id] = [h.vec_id for h in hits if h.vec_id != q.vec_id][:10]
    found = {}
    for r in vectors.lsh_top_k(every, queries, 10).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hit = sum(len(found.get(q, set()) & set(ids)) for q, ids in exact.items())
    assert hit >= 0.9 * sum(map(len, exact.values()))
